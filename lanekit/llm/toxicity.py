"""Toxicity with a bidirectional gated recurrent network.

A step's input is a word: the embedding of the word itself, if training saw
it often enough, beside the mean embedding of its character trigrams. Two
gated recurrent units read a window of words in both directions, attention
pools their states, and a logistic output scores the window. Words of more
than ``LONG_WORD`` characters, as in scripts without spaces, are cut at their
punctuation and into overlapping pieces, each a step. Windows of
``WINDOW`` words overlap by half, cover every whole text, and the highest
window is the text's score.

The network is trained in numpy on a bounded sample of labelled texts
(``TRAIN_TOXIC`` and ``TRAIN_CLEAN``, first in an order by hash, of distinct
texts). Only texts are labelled, not windows: training starts from random
windows of toxic texts and goes on with those the network itself finds most
toxic.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import first_by_hash, held_out, learnable, stage

WINDOW = 32
STRIDE = 16
LONG_WORD = 24
PIECE = 4
PIECE_STRIDE = 2
STATE = 8
WORD_DIMS = 8
CHAR_DIMS = 8
VOCABULARY = 20_000
MIN_TEXTS = 4
GRAM_BUCKETS = 1 << 12
TRAIN_TOXIC = 1500
TRAIN_CLEAN = 3000
EPOCHS = 9
THRESHOLD = 0.7

_EDGES = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]))


_JOINTS = re.escape(_EDGES) + "\u2010-\u2027\u3001-\u3003\u3008-\u3011\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\u200b\u2060\ufeff"
_PARTS = re.compile(f"[^{_JOINTS}]+[{_JOINTS}]*|[{_JOINTS}]+")


# ------------------------------------------------------------------- inputs

def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, owner) of all character trigrams of words with their edges
    marked; a word of n characters has n."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), sizes)
    code = points.astype(np.uint64)
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1]) * np.uint64(0xBF58476D1CE4E5B9) + code[2:]
    code = (code ^ (code >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    inside = owner[:-2] == owner[2:]
    return (code[inside] >> np.uint64(40)).astype(np.int32) % GRAM_BUCKETS, owner[:-2][inside]


def tokens(text: str | None) -> list[str]:
    """Words in lower case; instead of a long one, its pieces."""
    words = (text or "").lower().split()
    if not words or max(map(len, words)) <= LONG_WORD:
        return words
    return [x for w in words for x in ((w,) if len(w) <= LONG_WORD else pieces(w))]


def pieces(word: str) -> Iterable[str]:
    """Every character of a long word, cut behind punctuation and invisible
    joints; what is still longer than ``PIECE`` and no plain word, into pieces
    that overlap by half."""
    for part in _PARTS.findall(word):
        if len(part) <= PIECE or (part.isascii() and len(part) <= LONG_WORD):
            yield part
            continue
        for i in range(0, len(part) - PIECE, PIECE_STRIDE):
            yield part[i:i + PIECE]
        yield part[-PIECE:]


def plain(word: str) -> str:
    """The word without punctuation at its edges (or itself, if nothing else
    is left of it)."""
    return word.strip(_EDGES) or word


def windows(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For texts of ``sizes`` words, laid out one after the other: positions
    (windows x WINDOW, -1 beyond the end) and the text each belongs to. Every
    word lies in a window, most in two; wordless texts have none."""
    size = np.array(sizes, np.int64)
    count = np.where(size > 0, 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(size)), count)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = turn[:, None] * STRIDE + np.arange(WINDOW)
    first = (np.cumsum(size) - size)[text]
    return np.where(at < size[text][:, None], first[:, None] + at, -1), text


# ------------------------------------------------------------------ network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """``p``: the parameters by name; words: number of each known word."""

    words: dict[str, int]
    p: dict[str, np.ndarray]

    @staticmethod
    def new(words: list[str], seed: int = 3) -> "Network":
        rng = np.random.default_rng(seed)
        d, h = WORD_DIMS + CHAR_DIMS, STATE
        shapes = {"word": (len(words) + 1, WORD_DIMS), "gram": (GRAM_BUCKETS, CHAR_DIMS), "x": (2, d, 3 * h),
                  "u": (2, h, 3 * h), "b": (2, 3 * h), "attend": (2 * h, h), "query": (h,), "out": (2 * h,),
                  "bias": (1,)}
        scale = {"word": 0.1, "gram": 0.3, "b": 0.0, "bias": 0.0}
        p = {n: rng.standard_normal(s).astype(np.float32) * np.float32(scale.get(n, 1 / np.sqrt(s[-2] if len(s) > 1 else s[0])))
             for n, s in shapes.items()}
        p["word"][0] = 0
        return Network({w: i + 1 for i, w in enumerate(words)}, p)

    def known(self, words: list[str]) -> np.ndarray:
        """0 for words training has not seen."""
        return np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))

    def inputs(self, words: list[str], known: np.ndarray, bucket: np.ndarray, owner: np.ndarray) -> np.ndarray:
        count = np.maximum(np.bincount(owner, minlength=len(words)), 1)
        x = np.empty((len(words), WORD_DIMS + CHAR_DIMS), np.float32)
        x[:, :WORD_DIMS] = self.p["word"][known]
        for k in range(CHAR_DIMS):
            x[:, WORD_DIMS + k] = np.bincount(owner, self.p["gram"][bucket, k], len(words)) / count
        return x

    def forward(self, step: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Scores (logits) of windows. ``step``: per direction, place and
        window the projected inputs, a pair of (WINDOW, n, 3 * STATE) arrays
        or functions of the place; ``mask`` (WINDOW, n) is 1 at words. With
        ``keep`` also what the gradient needs."""
        p, h, n = self.p, STATE, mask.shape[1]
        states = np.zeros((2, WINDOW, n, h), np.float32)
        saved: list[list] = [[None] * WINDOW, [None] * WINDOW]
        for way in (0, 1):
            u, state = p["u"][way], np.zeros((n, h), np.float32)
            for t in (range(WINDOW) if way == 0 else range(WINDOW - 1, -1, -1)):
                x, m = step(way, t), mask[t][:, None]
                g = state @ u
                zr = _sigmoid(x[:, :2 * h] + g[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h:] + r * g[:, 2 * h:])
                after = state + m * (1 - z) * (new - state)
                if keep:
                    saved[way][t] = (state, z, r, new, g[:, 2 * h:])
                states[way, t] = state = after
        both = np.concatenate([states[0], states[1]], 2)                     # (WINDOW, n, 2h)
        seen = np.tanh(both @ p["attend"])
        weight = np.where(mask > 0, seen @ p["query"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", weight, both)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, (states, saved, both, seen, weight, pooled)) if keep else logit

    def projected(self, x: np.ndarray) -> list[np.ndarray]:
        """Inputs (words, dims) through both directions' input weights, with a
        last row for places without a word."""
        out = [x @ self.p["x"][way] + self.p["b"][way] for way in (0, 1)]
        return [np.concatenate([o, np.zeros((1, o.shape[1]), np.float32)]) for o in out]

    def logits(self, x: np.ndarray, at: np.ndarray, batch: int = 2048) -> np.ndarray:
        """Scores of windows ``at`` (n, WINDOW; rows of ``x`` or -1)."""
        ways = self.projected(x)
        found = np.zeros(len(at), np.float32)
        for i in range(0, len(at), batch):
            part = np.ascontiguousarray(at[i:i + batch].T)
            found[i:i + batch] = self.forward(lambda way, t: ways[way][part[t]], (part >= 0).astype(np.float32))
        return found

    def gradient(self, x: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """(gradients of the parameters behind the inputs, gradient of ``x``)
        of the weighted mean logistic loss."""
        p, h = self.p, STATE
        part = np.ascontiguousarray(at.T)
        mask = (part >= 0).astype(np.float32)
        ways = self.projected(x)
        logit, (states, saved, both, seen, attention, pooled) = self.forward(
            lambda way, t: ways[way][part[t]], mask, keep=True)
        error = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ error, "bias": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * p["out"]
        d_both = attention[:, :, None] * d_pooled
        d_weight = np.einsum("nk,tnk->tn", d_pooled, both)
        d_score = attention * (d_weight - (attention * d_weight).sum(axis=0))
        d_seen = d_score[:, :, None] * p["query"] * (1 - seen ** 2)
        g["query"] = np.einsum("tn,tnk->k", d_score, seen)
        g["attend"] = np.einsum("tnk,tnj->kj", both, d_seen, optimize=True)
        d_both += d_seen @ p["attend"].T
        d_ways = [np.zeros_like(w) for w in ways]
        g["u"], g["b"], g["x"] = (np.zeros_like(p[k]) for k in ("u", "b", "x"))
        for way in (0, 1):
            u, d_state = p["u"][way], np.zeros((len(at), h), np.float32)
            for t in (range(WINDOW - 1, -1, -1) if way == 0 else range(WINDOW)):
                before, z, r, new, gn = saved[way][t]
                d_after = d_state + d_both[t, :, way * h:(way + 1) * h]
                d_in = d_after * mask[t][:, None]
                d_new = d_in * (1 - z) * (1 - new ** 2)
                d_z = d_in * (before - new) * z * (1 - z)
                d_r = d_new * gn * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], 1)
                d_g = np.concatenate([d_z, d_r, d_new * r], 1)
                g["u"][way] += before.T @ d_g
                d_state = d_after - d_in + d_in * z + d_g @ u.T
                np.add.at(d_ways[way], part[t], d_x)
            d = d_ways[way][:-1]
            g["x"][way], g["b"][way] = x.T @ d, d.sum(axis=0)
        return g, d_ways[0][:-1] @ p["x"][0].T + d_ways[1][:-1] @ p["x"][1].T


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray], rate: float, decay: dict[str, float]) -> None:
        self.t += 1
        for k, d in g.items():
            d = d + decay.get(k, 0.0) * self.p[k]
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            top = self.m[k] / (1 - 0.9 ** self.t)
            self.p[k] -= (rate * top / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)).astype(np.float32)


# ----------------------------------------------------------------- training

class Texts:
    """Texts as numbers of distinct words, with their windows. Words are read
    once and not kept, but for the distinct ones."""

    def __init__(self, texts: Iterable[list[str]]):
        number: dict[str, int] = {}
        self.parts = [np.fromiter((number.setdefault(w, len(number)) for w in t), np.int32, len(t)) for t in texts]
        at, self.text = windows([len(p) for p in self.parts])
        self.at = np.concatenate([*self.parts, np.full(1, -1, np.int32)])[at]
        self.words = [plain(w) for w in number]
        self.bucket, self.owner = grams(self.words)
        self.known = np.zeros(len(self.words), np.int64)

    def vocabulary(self, limit: int = VOCABULARY, least: int = MIN_TEXTS) -> list[str]:
        """The words of most texts (of ``least`` at least), at most ``limit``."""
        number: dict[str, int] = {}
        of = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, len(self.words))
        count = np.zeros(len(number), np.int64)
        for p in self.parts:
            count[np.unique(of[p])] += 1
        return sorted((w for w, i in number.items() if count[i] >= least), key=lambda w: (-count[number[w]], w))[:limit]


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 5) -> Network | None:
    """Fits on labelled texts; None unless both labels occur among texts with
    words."""
    kept = [i for i, t in enumerate(texts) if t and t.split()]
    y = np.array([labels[i] for i in kept], np.float32)
    if len(set(y.tolist())) < 2:
        return None
    data = Texts(tokens(texts[i]) for i in kept)
    net = Network.new(data.vocabulary())
    data.known = net.known(data.words)
    rng, adam = np.random.default_rng(seed), Adam(net.p, 0.02)
    balance = np.where(y > 0, 1.0, min(1.0, float(y.sum()) / max(float((1 - y).sum()), 1.0) * 2)).astype(np.float32)
    order = np.argsort(data.text, kind="stable")
    begin = np.searchsorted(data.text, np.arange(len(y)))
    count = np.searchsorted(data.text, np.arange(len(y)), "right") - begin
    ranked = None
    for epoch in range(epochs):
        picks = [order[begin + (rng.random(len(y)) * count).astype(np.int64)] for _ in range(2)]
        if epoch >= 3 and epoch % 2:
            x = net.inputs(data.words, data.known, data.bucket, data.owner)
            ranked = np.lexsort((-net.logits(x, data.at), data.text))
        if ranked is not None:
            # of toxic texts only windows found toxic, of clean ones also others
            picks = [ranked[begin], np.where(y > 0, ranked[begin + np.minimum(1, count - 1)], picks[0])]
        rows = np.concatenate(picks)
        of = data.text[rows]
        shuffle = rng.permutation(len(rows))
        rate = 0.02 * 0.5 ** (max(0, epoch - epochs // 2) / 2)
        for i in range(0, len(rows), 256):
            part = rows[shuffle[i:i + 256]]
            _step(net, data, data.at[part], y[of[shuffle[i:i + 256]]], balance[of[shuffle[i:i + 256]]], adam, rate, rng)
    return net


def _step(net: Network, data: Texts, at, y, weight, adam: Adam, rate: float, rng) -> None:
    used, local = np.unique(at, return_inverse=True)
    local = local.reshape(at.shape)
    if used[0] < 0:
        used, local = used[1:], local - 1
    first = np.searchsorted(data.owner, used)                                    # owners come in order
    size = np.searchsorted(data.owner, used, "right") - first
    owner = np.repeat(np.arange(len(used)), size)
    bucket = data.bucket[np.arange(len(owner)) + np.repeat(first - np.cumsum(size) + size, size)]
    known = np.where(rng.random(len(used)) < 0.3, 0, data.known[used])         # words drop out, characters stay
    names = [data.words[i] for i in used.tolist()]
    x = net.inputs(names, known, bucket, owner)
    g, d_x = net.gradient(x, local, y, weight)
    g["word"], g["gram"] = np.zeros_like(net.p["word"]), np.zeros_like(net.p["gram"])
    np.add.at(g["word"], known, d_x[:, :WORD_DIMS])
    g["word"][0] = 0
    count = np.maximum(np.bincount(owner, minlength=len(used)), 1)
    np.add.at(g["gram"], bucket, (d_x[:, WORD_DIMS:] / count[:, None])[owner])
    adam.step(g, rate, {"gram": 1e-5, "x": 1e-5, "u": 1e-5, "out": 1e-5})


def sample(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC,
           clean: int = TRAIN_CLEAN) -> tuple[list[str], list[int]]:
    """At most ``toxic + clean`` different labelled texts that may be learned
    from. Texts are told apart by a hash and chosen by it on narrow rows before
    any is fetched, so neither a hot id nor a hot text adds rows. Of
    contradicting labels of one text the toxic one counts."""
    marked = (labels.filter(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.filter(learnable(F.col("doc_id")) & F.col("text").isNotNull()).select(
        "doc_id", "text", F.xxhash64("text").alias("same"))
    there = stage(texts.select("doc_id", "same").distinct().join(marked, "doc_id")
                  .groupBy("same").agg(F.max("toxic").alias("toxic")), "toxicity-texts")
    sizes = {r["toxic"]: r["count"] for r in there.groupBy("toxic").count().collect()}
    chosen = first_by_hash(there, "toxic", sizes, max(toxic, clean), "toxicity", "same").filter(
        F.col("turn") <= F.when(F.col("toxic") == 1, toxic).otherwise(clean))
    # at most toxic + clean hashes
    rows = (texts.join(F.broadcast(chosen), "same")
            .groupBy("same").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
            .toPandas().sort_values("same"))
    return rows.text.tolist(), rows.toxic.tolist()


# ----------------------------------------------------------------- operator

def scores(net: Network, texts: list[str | None], batch_words: int = 60_000) -> list[float]:
    """The highest window score of each whole text; 0 for wordless texts."""
    out: list[float] = []
    at = 0
    while at < len(texts):
        held, part = 0, []
        while at < len(texts) and held < batch_words:
            part.append(tokens(texts[at]))
            held += len(part[-1])
            at += 1
        best = np.full(len(part), -np.inf)
        if held:
            data = Texts(part)
            data.known = net.known(data.words)
            x = net.inputs(data.words, data.known, data.bucket, data.owner)
            np.maximum.at(best, data.text, net.logits(x, data.at))
        out += np.where(np.isfinite(best), 1 / (1 + np.exp(-np.clip(best, -50, 50))), 0.0).tolist()
    return out


def scored(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` (column text; any others stay) with ``score``; null, empty and
    wordless texts have 0, as have all without a network."""
    shared = docs.sparkSession.sparkContext.broadcast(net)       # vocabulary and weights, about 1 MB

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found = scores(shared.value, texts.to_pylist()) if shared.value else [0.0] * len(texts)
        return pa.array(found, pa.float64())

    return docs.withColumn("score", run("text"))


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id,
    text), by a network trained on ``labels`` (doc_id, toxic) of texts that may
    be learned from. Of contradicting labels of one id the toxic one counts.
    Null ids are not held out; repeated rows get the same score; an empty
    table gives none."""
    net = train(*sample(docs, labels))
    return scored(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
