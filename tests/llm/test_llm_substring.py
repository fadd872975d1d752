import hashlib
import random

import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from lanekit.llm import substring
from lanekit.llm.queries import QUERIES
from llm_helpers import edge_docs, empty_docs


def brute(rows, window):
    """(doc_id, n_words, n_removed, sha) per row; equal (id, text) rows are
    one document."""
    def order(key):
        d, t = key
        uid = xxhash.xxh64_intdigest((t or "").encode(), 42) if t is not None else 42
        return (-1 << 63 if d is None else d, uid - (1 << 64) if uid >> 63 else uid)

    seen, out = set(), {}
    for d, t in sorted(set(rows), key=order):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            if k in seen:
                gone[i:i + window] = [True] * window
            seen.add(k)
        kept = [x for x, g in zip(w, gone) if not g]
        out[d, t] = len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()
    return sorted((d is None, d, *out[d, t]) for d, t in rows)


def got(docs, window=20, **limits):
    rows = substring.dedup(docs, "q", window, **limits).collect()
    return sorted((r.doc_id is None, r.doc_id, r.q.n_words, r.q.n_removed, r.q.kept_sha256) for r in rows)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = QUERIES["op10_substring_dedup"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id is None, *r) for r in rows) == brute(docs, 20)


LIMITS = [{}, {"pass_words": 500, "batch_bytes": 4000}, {"hot_words": 100, "batch_bytes": 3000}]


@pytest.mark.parametrize("limits", [*LIMITS, {"row_words": 0, "group_words": 300}, {"row_words": 0, "pass_words": 300, "hot_words": 100},
                                    {"row_words": 0.6, "batch_bytes": 3000, "group_words": 200}])
def test_shared_passages_and_copies(spark, limits):
    # rows per bucket, per part, and both; parts solved together and one by one, in passes, dealt again
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    passages = [" ".join(rng.choices(vocab, k=rng.randint(5, 60))) for _ in range(8)]
    rows = []
    for d in range(300):
        parts = [" ".join(rng.choices(vocab, k=rng.randint(0, 30)))] + rng.sample(passages, rng.randint(0, 3))
        rng.shuffle(parts)
        rows.append((d, "\n".join(parts) if d % 3 else passages[0] + " " + passages[1]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for window in (4, 20):
        assert got(docs, window, **limits) == brute(rows, window)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    done = substring.drop_repeats(docs)
    assert done.columns == docs.columns and done.count() == docs.count()
    assert substring.dedup(empty_docs(spark), "q").count() == 0


def test_text_keeps_its_lines(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, passage), (2, "first line\n" + passage + "\nlast line"), (3, passage), (4, None)]
    done = {r.doc_id: r.text for r in substring.drop_repeats(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert done == {1: passage, 2: "first line\nlast line", 3: "", 4: None}


def test_hash_collisions_are_told_apart():
    ids = np.array([1, 2, 3, 4, 1, 2, 9, 9])
    group = substring._by_words(ids, np.array([0, 4, 2, 6]), np.array([0, 0, 1, 1]), 2)
    assert group[0] == group[1] and group[2] != group[3]


def test_run_hashes_and_sliding_min():
    values = np.random.default_rng(0).integers(0, 1 << 60, 200).astype(np.uint64)
    values[100:130] = values[:30]
    for n in (1, 2, 3, 5, 18, 20):
        hashes = substring.run_hashes(values, n)
        assert len(hashes) == 201 - n
        assert (hashes[:31 - n] == hashes[100:131 - n]).all() and len(np.unique(hashes)) == 201 - n - (31 - n)
        assert substring.sliding_min(values, n).tolist() == [values[i:i + n].min() for i in range(201 - n)]


def test_words_that_share_a_hash_are_told_apart(spark, monkeypatch):
    # a hash of the length alone: nearly all words collide, and the words are numbered instead
    monkeypatch.setattr(substring, "word_hashes", lambda text, first, after: (after - first).astype(np.uint64) * np.uint64(977))
    docs = [(1, 5, b"a b c d e f g"), (2, 5, b"x b c d e f y"), (3, 5, b"a b c d q q q"), (4, 5, b"p q r s t u v")]
    packs, marks = substring.pack(docs, 3)
    at, string, later, _ = substring.windows_of(packs.compact(), 3, substring.word_hashes)
    begin = np.cumsum(packs.length) - packs.length
    found = {(int(packs.did[s]), int(packs.start[s] + a - begin[s])) for a, s, gone in zip(at, string, later) if gone}
    for did, start, length in zip(*[m.tolist() for m in (marks[0], marks[2], marks[3])]):
        found |= {(did, start + i) for i in range(length - 2)}
    assert found == {(2, 1), (2, 2), (2, 3), (3, 0), (3, 1)}


def test_word_hashes_see_every_byte():
    words = [b"a", b"b", b"ab", b"ba", b"x" * 5000, b"x" * 4999 + b"y", b"x" * 1024, b"\xc3\xa9", b"a"]
    text, first, after, owner = substring._words_of([(0, 0, b" \t" + b" \n ".join(words)), (1, 0, b"  "), (2, 0, b"ab  ")])
    assert [bytes(text[a:b]) for a, b in zip(first, after)] == [*words, b"ab"] and owner.tolist() == [0] * 9 + [2]
    hashes = substring.word_hashes(text, first, after)
    assert hashes[0] == hashes[8] and hashes[2] == hashes[9] and len(set(hashes.tolist())) == 8


def test_a_window_in_every_batch_is_dealt_again_once_a_slice():
    # one minimiser with very many copies: every slice hands on each of its windows once
    text = b" ".join(b"w%d" % i for i in range(30))
    blobs = []
    for d in range(40):
        packs, _ = substring.pack([(d, 0, text + b" end%d" % d)], 20)
        blobs += [row[3] for row in substring._ship(packs, 1)]
    words = int(substring.load([(b, None) for b in blobs]).length.sum())
    rows = [r for b in substring._solve_bucket(20, 1, 10 ** 9, 200)(iter(_record(blobs))) for r in b.to_pylist()]
    again = substring.load([(r["data"], None) for r in rows if r["data"] is not None])
    assert (again.length == 20).all() and np.unique(again.key, return_counts=True)[1].max() <= words // 200 + 2 < 20


def _record(blobs):
    import pyarrow as pa
    n = len(blobs)
    return [pa.RecordBatch.from_pydict({"part": pa.array([0] * n, pa.int32()), "fine": pa.array([0] * n, pa.int32()),
                                        "words": pa.array([1] * n, pa.int64()), "data": pa.array(blobs, pa.binary()),
                                        "did": pa.nulls(n, pa.int64()), "uid": pa.nulls(n, pa.int64()), "cuts": pa.nulls(n, pa.binary())})]
