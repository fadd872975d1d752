"""Conversation prefix trie: brute force, deep sequences, hot prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from llm_helpers import words

from lanekit.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def code(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute_sequences(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), code(role, text), (role or "", text or "")))
    own = {c: [t[2] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    sequences = brute_sequences(rows)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        childless = [n for n in below if not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(words(n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(n) == len(node) + 1 for n in below), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(df).select(*COLUMNS).collect()), key=str)


def random_rows(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 130), n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "a b", "", "c d e"])))
    return rows


@pytest.mark.parametrize("seed, n, longest", [(1, 60, 5), (2, 40, 12), (3, 12, 40)])
def test_equals_brute_force(spark, seed, n, longest):
    rows = random_rows(seed, n, longest)
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


@pytest.mark.parametrize("length", [1, 2, 3, 4, 7, 8, 9, 16])
def test_every_depth_around_the_cuts(spark, length):
    rows = [(c, t, "user", f"w{t} same" if t < length - 1 else f"end {c}") for c in (20, 40, 41) for t in range(length)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "lost"), (40, None, None, None), (40, None, "", ""), (40, 2, "user", "x y"), (40, 2, "user", "x y"),
            (41, 0, "us", "er x"), (41, 1, "user", "x"), (-3, 0, "user", "negative"), (-20, 0, "user", "n base"), (-20, 1, "a", "b"),
            (60, 5, "user", "w " * 50_000), (61, 1, "user", "only"), (75, 1, None, "z")]
    clash = "pos int, code int, words int, name int, depth int, part int, conv int"
    df = spark.createDataFrame([r + (7,) * 7 for r in rows], f"{SCHEMA}, {clash}")
    assert run(df) == brute(rows)


def test_no_rows(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_turnless_conversations_end_at_the_root(spark):
    # a single turn, replaced by nothing: the group's first conversation is absent
    ids = [c for c in range(1, 60) if zlib.crc32(str(c).encode()) % 4 >= 1 and c % 20][:12]
    rows = [(c, 0, "user", "gone") for c in ids]
    got = run(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert len(got) == 1 and got[0][4:6] == (0, 1)


def test_lists_of_ids_are_cut_and_digested_in_order():
    import pyarrow as pa
    ids = {b"a": list(range(-5, 300)), b"b": [7], b"c": list(range(1000, 1100))}
    rows = [(n, c) for n, cs in ids.items() for c in cs]
    batches = [pa.RecordBatch.from_pydict({"name": [r[0] for r in rows[i:i + 50]], "conv": [r[1] for r in rows[i:i + 50]]})
               for i in range(0, len(rows), 50)]
    lists = list(prefixtrie._chunks(iter(batches), 100))
    assert sum(b.num_rows for b in lists) > 20
    found = [tuple(r.values()) for b in prefixtrie._digests(iter(lists)) for r in b.to_pylist()]
    assert found == [(n, hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()) for n, cs in ids.items()]


def test_copies_of_one_conversation(spark):
    # its ids are joined in many ranges, then digested in order
    ids = sorted({20 * i for i in range(500)} | {-20 * i for i in range(1, 30)})
    df = spark.createDataFrame([(c, t, "user", f"t{t}") for c in ids for t in range(3)], SCHEMA)
    got = run(df)
    assert len(got) == 4
    assert {r[7] for r in got if r[1] == 3} == {hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()}


def test_one_deep_conversation(spark, monkeypatch):
    # deeper than the stages that cut the lineage; its turns are numbered by several tasks
    monkeypatch.setattr(prefixtrie, "HOT_TURNS", 50)
    rows = [(40, t, "user", f"w{t % 3}") for t in range(300)] + [(60, t, "user", f"w{t % 3}") for t in range(150)]
    got = {(r[0], r[1]): r for r in run(spark.createDataFrame(rows, SCHEMA))}
    assert len(got) == 301
    assert got[40, 300][2:7] == (40, 1, 0, 1, 0)
    assert got[40, 150][3] == 2 and got[40, 1][6] == 150 and got[40, 0][5] == 1
