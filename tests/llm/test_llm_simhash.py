import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL, plan_text
from lanekit.llm import simhash
from lanekit.llm.graph import components as graph_components
from lanekit.llm.queries import QUERIES
from llm_helpers import components, edge_docs, empty_docs, words


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """{row number: (fingerprint, component)} of (doc_id, text) rows."""
    prints = [brute_print(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    group = components(len(rows), pairs)
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    return sorted(((d is None, d), f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, group))


@pytest.mark.parametrize("table", ["edge", "small"])
def test_matches_brute_force(spark, table):
    docs = edge_docs(spark) if table == "edge" else spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = simhash.near_duplicates(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id is None, r.doc_id), r.fingerprint, r.component_id) for r in got) == brute(rows)


def test_query_covers_the_table(spark):
    got = QUERIES["op9_simhash_near_dedup"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_golay_code_is_perfect():
    """Every 23-bit value has exactly one anchor within the radius."""
    pattern, excess, first, upto = simhash._errors(0)
    assert len(pattern) == 2048 and (upto == 1).all()
    rng = np.random.default_rng(0)
    owner, anchor, home = simhash.anchors(rng.integers(-2**62, 2**62, 50), 2)
    assert np.bincount(owner[home]).tolist() == [1] * 50
    assert (simhash._remainder(anchor & (2**23 - 1)) == 0).all()


def cluster(n=1500, seed=1):
    """Fingerprints around a few centres, one of them very dense."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(-2**62, 2**62, 40)
    found = [centres]
    for _ in range(n // 40):
        x = centres.copy()
        for _ in range(3):
            x = x ^ (np.int64(1) << rng.integers(0, 62, len(x)) * (rng.random(len(x)) < 0.6))
        found.append(x)
    dense = centres[0]
    for _ in range(n):
        found.append(np.array([dense ^ sum(np.int64(1) << b for b in set(rng.integers(0, 12, 3).tolist()))]))
    return np.unique(np.concatenate(found))


@pytest.mark.parametrize("limits", [{}, {"HOMES_PER_PART": 3, "ROWS_PER_CHUNK": 50, "PAIRS_PER_STEP": 64}])
def test_links_connect_like_all_pairs(spark, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(simhash, k, v)
    fp = cluster(300 if limits else 1500)
    got = simhash.links(spark.createDataFrame([(int(x),) for x in fp], "fp bigint")).collect()
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    number = {int(x): i for i, x in enumerate(fp)}
    assert components(len(fp), [(number[r.a], number[r.b]) for r in got]) == components(len(fp), np.argwhere(near).tolist())


def test_replicas_are_not_broadcast(spark, tmp_path):
    """Some 60 rows per fingerprint, which the planner takes for one."""
    fp = np.random.default_rng(3).integers(-2**62, 2**62, 3000)
    spark.createDataFrame([(int(x),) for x in fp], "fp bigint").coalesce(1).write.parquet(f"{tmp_path}/prints")
    got = simhash.links(spark.read.parquet(f"{tmp_path}/prints"))
    got.collect()
    assert "SortMergeJoin" in plan_text(got) and "Broadcast" not in plan_text(got)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1001), (1001, 1002), (2000, 2000), (None, 5)]
    got = {r.node: r.root for r in graph_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(401)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert graph_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = edge_docs(spark)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    group = {g for *_, g in brute([(r.doc_id, r.text) for r in docs.collect()])}
    rows = kept.collect()
    prints = [brute_print(r.text) for r in rows]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
    assert {r.doc_id for r in rows} >= group - {None}
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0
    assert simhash.one_per_group(empty_docs(spark)).count() == 0


def test_rejects_distances_beyond_the_anchors(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp bigint"), 4)
