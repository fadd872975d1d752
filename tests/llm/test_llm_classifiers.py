import tracemalloc
import zlib

import numpy as np
import pandas as pd

from lanekit.llm import langid, toxicity
from lanekit.llm.queries import QUERIES
from llm_helpers import PROSE, edge_docs, empty_docs

SF = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# ------------------------------------------------------------- language ID

def test_language_accuracy_on_held_out(spark):
    got = QUERIES["op5_language_id"](spark, SF).toPandas().merge(pd.read_parquet(f"{SF}/documents.parquet"), on="doc_id")
    assert (got.held_out == got.doc_id.map(held)).all()
    assert (got.lang_pred == got.lang)[got.held_out].mean() > 0.97
    assert got.score.between(0, 1).all()


def test_presence_matches_brute_force():
    text = "Áb c,  1d日"
    assert "".join(map(chr, langid.letters(text))) == " áb c d日 "
    assert "".join(map(chr, langid.letters("42"))) == ""
    grams = {" áb c d日 "[i:i + n] for n in (1, 2, 3) for i in range(9 - n + 1)}
    assert 0 < len(langid.presence(text)) <= len(grams)
    assert len(langid.presence(text)) >= len(grams) - 1                # a collision at most
    assert (langid.presence(text * 50) != langid.presence(text * 60)).sum() == 0


def test_model_is_kernel_ridge_on_landmarks():
    """The folded matrix gives what the kernel form gives."""
    rng = np.random.default_rng(0)
    at = [np.sort(rng.choice(langid.BUCKETS, 40, replace=False)) for _ in range(60)]
    x, bits = langid.dense(at), np.array([np.frombuffer(langid.packed(a), np.uint8) for a in at])
    assert np.allclose(langid.unit_rows(bits), x)
    langs = ["a" if i % 3 else "b" for i in range(60)]
    landmark = np.arange(60) < 20
    model = langid.fit(bits, langs, landmark, ridge=0.1, block=17)
    marks = x[landmark].astype(float)
    kernel = x @ marks.T
    value, vector = np.linalg.eigh(marks @ marks.T)
    feature = kernel @ (vector / np.sqrt(value))
    y = np.array([[c == n for n in ("a", "b")] for c in langs], float)
    f, t = feature - feature.mean(0), y - y.mean(0)
    # dual form: the same ridge regression through the kernel of the features
    dual = np.linalg.solve(f @ f.T + 0.1 * 60 * np.eye(60), t)
    assert np.allclose(f @ (f.T @ dual) + y.mean(0), x @ model.weights + model.offset, atol=1e-4)


def test_language_edge_rows(spark):
    docs = edge_docs(spark)
    got = langid.predictions(docs).collect()
    assert len(got) == docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for r in got:
        if not any(any(c.isalpha() for c in t or "") for t in texts[r.doc_id]):
            assert r.lang_pred == "und" and r.score == 0
        assert 0 <= r.score <= 1
    assert langid.predictions(empty_docs(spark)).count() == 0
    unlabelled = docs.withColumn("lang", docs.lang.substr(1, 0)).replace("", None, subset=["lang"])
    assert {r.lang_pred for r in langid.predictions(unlabelled).collect()} == {"und"}


# ----------------------------------------------------------------- toxicity

def test_toxicity_on_held_out(spark):
    got = QUERIES["op2_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()
    seen = got.merge(labels, on="doc_id")
    seen = seen[seen.held_out]
    assert (seen.held_out == seen.doc_id.map(held)).all()
    assert (seen.predicted == seen.toxic).mean() > 0.95
    assert seen.predicted[seen.toxic == 0].mean() < 0.03
    assert seen.predicted[seen.toxic == 1].mean() > 0.8


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.new(["a"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y, w = rng.standard_normal((6, 16)), np.array([0, 1, 1, 0, 1.0]), np.array([1, 1, 0.5, 1, 2.0])
    at = np.sort(rng.integers(-1, 6, (5, toxicity.WINDOW)), axis=1)[:, ::-1]

    def loss():
        ways, part = net.projected(x), np.ascontiguousarray(at.T)
        out = net.forward(lambda way, t: ways[way][part[t]], (part >= 0).astype(float))
        return float(((np.log1p(np.exp(out)) - y * out) * w).sum() / w.sum())

    g, d_x = net.gradient(x, at, y, w)
    for values, grads in [(net.p[k], g[k]) for k in ("x", "u", "b", "attend", "query", "out", "bias")] + [(x, d_x)]:
        i = tuple(int(rng.integers(0, s)) for s in values.shape)
        old = values[i]
        values[i] = old + 1e-3
        high = loss()
        values[i] = old - 1e-3
        low = loss()
        values[i] = old
        assert abs(grads[i] - (high - low) / 2e-3) < 2e-3 * max(1e-2, abs(grads[i])) + 1e-5


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 200):
        at, text = toxicity.windows([3, n, 5])
        own = at[text == 1]
        assert set(own[own >= 0].tolist()) == set(range(3, 3 + n))
        if n > toxicity.WINDOW:
            assert len(own) == 1 + -(-(n - toxicity.WINDOW) // toxicity.STRIDE)


def test_grams():
    bucket, owner = toxicity.grams(["ab", "é", "ab"])
    assert owner.tolist() == [0, 0, 1, 2, 2] and bucket[:2].tolist() == bucket[3:].tolist()


def test_learns_the_words_that_mark_toxic_texts():
    rng = np.random.default_rng(2)
    vocab = PROSE.split()
    texts, labels = [], []
    for i in range(500):
        words = rng.choice(vocab, rng.integers(20, 150)).tolist()
        labels.append(int(i % 4 == 0))
        if labels[-1]:
            for at in rng.integers(0, len(words), 3):
                words[at] = rng.choice(["zorgish", "Blarg!"])
        texts.append(" ".join(words))
    net = toxicity.train(texts, labels)
    got = toxicity.scores(net, [" ".join(vocab * 3 + ["zorgish", "blarg"] + vocab * 3), " ".join(vocab * 6), "", None])
    assert got[0] > 0.7 > 0.3 > got[1] and got[2:] == [0.0, 0.0]
    assert toxicity.train(["a b"], [1]) is None and toxicity.train([], []) is None


def test_toxicity_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 1, 0), (None, 1, 1), (7, None, None), (8, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = toxicity.predictions(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.predictions(empty_docs(spark), labels).count() == 0
    assert {r.score for r in toxicity.predictions(docs, labels.limit(0)).collect()} == {0.0}


def test_long_words_are_cut_into_pieces():
    assert toxicity.tokens("A short text") == ["a", "short", "text"]
    joined = "one,two\u200bthree." + "x" * 30
    parts = toxicity.tokens(joined)
    assert parts[:3] == ["one,", "two\u200b", "three."] and set(map(len, parts[3:])) == {toxicity.PIECE}
    text = "".join(map(chr, range(0x4E00, 0x4E00 + 1003)))
    parts = toxicity.tokens(text)
    assert parts[0] == text[:4] and parts[-1] == text[-4:]
    assert all(any(text[i:i + 3] in p for p in parts[max(0, i // 2 - 2):i // 2 + 2]) for i in range(1000))


def test_toxic_phrases_in_texts_without_spaces():
    rng = np.random.default_rng(4)
    vocabulary = ["".join(map(chr, rng.integers(0x4E00, 0x4F00, k))) for k in rng.integers(2, 4, 60)]
    toxic = "\u6bd2\u6bd3\u6bd4\u6bd5"
    texts, labels = [], []
    for i in range(500):
        text = "".join(rng.choice(vocabulary, rng.integers(30, 200)))
        labels.append(int(i % 4 == 0))
        for at in rng.integers(0, len(text), 3 * labels[-1]):
            text = text[:at] + toxic + text[at:]
        texts.append(text)
    net = toxicity.train(texts, labels)
    clean = "".join(rng.choice(vocabulary, 2_000))
    *got, without = toxicity.scores(net, [*(clean[:k] + toxic + clean[k:] for k in range(2_001, 2_009)), clean])
    assert min(got) > max(without, 0.7)
    vocab = PROSE.split()
    spaced = [" ".join([*rng.choice(vocab, 60), *(["zorgish", "blarg"] if i % 4 == 0 else [])]) for i in range(400)]
    net = toxicity.train(spaced, [int(i % 4 == 0) for i in range(400)])
    got = toxicity.scores(net, ["\u200b".join(vocab * 9 + ["zorgish", "blarg"] + vocab * 9), ".".join(vocab * 18)])
    assert got[0] > 0.7 > got[1]


def test_every_language_is_learned(spark):
    """More languages than 64, each written with letters of its own."""
    rows = [(100 * k + i, " ".join(chr(0x4E00 + 40 * k + ((i + 1) * j) % 37) * 2 for j in range(1, 12)), f"l{k}")
            for k in range(80) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predictions(docs).collect() if r.held_out}
    wanted = {i: lang for i, _, lang in rows if i in got}
    assert len(set(wanted.values())) > 70
    assert sum(got[i] == wanted[i] for i in got) > 0.95 * len(got)
    few = langid.train(docs, total=160, total_landmarks=80)
    assert len(few.langs) == 80


def test_largest_fit_is_bounded():
    """As many rows as the bounds allow, of 64 languages."""
    rng = np.random.default_rng(1)
    n, langs = langid.TRAIN_TOTAL, [f"l{i % 64}" for i in range(langid.TRAIN_TOTAL)]
    bits = (rng.integers(0, 256, (n, langid.BUCKETS // 8), np.uint8) & rng.integers(0, 256, (n, langid.BUCKETS // 8), np.uint8))
    own = np.arange(n) % 64
    bits[np.arange(n), own] = 255                                # eight features of its own
    bits[:, :64][np.arange(64) != own[:, None]] = 0
    tracemalloc.start()
    try:
        model = langid.fit(bits, langs, np.arange(n) < langid.LANDMARKS_TOTAL)
        assert tracemalloc.get_traced_memory()[1] < 600e6
    finally:
        tracemalloc.stop()
    assert len(model.langs) == 64


def test_hot_ids_and_hot_texts_add_no_rows(spark):
    """A third of the rows has one id, another third one text."""
    rng = np.random.default_rng(6)
    vocab = PROSE.split()
    rows = [(1 if i % 3 == 0 else 10 + i, PROSE if i % 3 == 1 else " ".join(rng.choice(vocab, 12)) + f" x{i}", "en" if i % 2 else "de")
            for i in range(6_000)]
    assert not held(1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got, _ = langid.sample(docs, 50, 10)
    assert len(got) == 100 and len({bytes(r["at"]) for r in got}) == 100
    labels = docs.select("doc_id", (docs.doc_id % 2).cast("int").alias("toxic"))
    texts, marks = toxicity.sample(docs, labels, 40, 60)
    assert len(texts) == len(set(texts)) == 100 and sum(marks) == 40
