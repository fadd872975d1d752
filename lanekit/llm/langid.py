"""Language identification with string kernels.

A text's blended spectrum is the set of its character n-grams of 1 to 3
letters (present or not, whatever their number), hashed to ``BUCKETS``
features. The kernel of two texts is the number of shared n-grams over the
geometric mean of their numbers. Nyström landmarks - some of the labelled
texts - turn it into finite features, on which one ridge regression per
language (that language against the rest) is solved in closed form. The
kernel is linear in the presence vectors, so landmarks and weights of the
fitted model multiply out to one matrix, and a batch of texts is scored by a
product of its presence matrix with it.

The classifier is fitted on a bounded sample of every labelled language: the
``TRAIN_PER_LANG`` texts that come first in an order by hash,
``LANDMARKS_PER_LANG`` of them as landmarks, and fewer of each language where
there are so many that the sum would pass ``TRAIN_TOTAL`` and
``LANDMARKS_TOTAL``. Copies of a text count once. A text comes to the driver as
``BUCKETS`` bits whatever its length, 52 MB for ``TRAIN_TOTAL`` texts, and is
multiplied in blocks of ``FIT_ROWS``.
Scoring takes every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import first_by_hash, fresh, held_out, learnable, stage

BUCKETS = 1 << 14
TRAIN_PER_LANG = 400
LANDMARKS_PER_LANG = 60
TRAIN_TOTAL = 64 * TRAIN_PER_LANG
LANDMARKS_TOTAL = 32 * LANDMARKS_PER_LANG
RIDGE = 1e-2
FIT_ROWS = 1024
UNKNOWN = "und"


# ----------------------------------------------------------------- features

def letters(text: str | None) -> np.ndarray:
    """Code points in lower case; every run of non-letters is one blank, and
    the text begins and ends with one. Empty if there is no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kept = np.where(_is_letter(points), points, np.uint32(32))
    if not (kept != 32).any():
        return kept[:0]
    kept = np.concatenate(([np.uint32(32)], kept, [np.uint32(32)]))
    blank = kept == 32
    return kept[np.append(True, ~(blank[1:] & blank[:-1]))]


_LETTER: np.ndarray | None = None


def _is_letter(points: np.ndarray) -> np.ndarray:
    """From a table that Unicode's own rule fills once per worker."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER[points]


def presence(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams of a whole text."""
    points = letters(text).astype(np.uint64)
    seen = np.zeros(BUCKETS, bool)
    code = np.zeros(len(points) + 1, np.uint64)
    for n in (1, 2, 3):
        code = code[:len(code) - 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:] + np.uint64(n)
        mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        seen[(mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def dense(rows: list[np.ndarray]) -> np.ndarray:
    """Presence matrix with rows of unit length."""
    out = np.zeros((len(rows), BUCKETS), np.float32)
    for row, at in zip(out, rows):
        row[at] = 1 / np.sqrt(max(len(at), 1))
    return out


# -------------------------------------------------------------------- model

@dataclass(frozen=True)
class Model:
    langs: list[str]
    weights: np.ndarray                     # (BUCKETS, languages)
    offset: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """One-versus-rest values of a batch of texts, cut to 0..1."""
        return np.clip(dense(rows) @ self.weights + self.offset, 0, 1)


def packed(at: np.ndarray) -> bytes:
    """A presence row as one bit per bucket."""
    row = np.zeros(BUCKETS, bool)
    row[at] = True
    return np.packbits(row).tobytes()


def unit_rows(bits: np.ndarray) -> np.ndarray:
    """Presence rows of unit length from rows of packed bits."""
    rows = np.unpackbits(bits, axis=1, count=BUCKETS).astype(np.float32)
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


def fit(bits: np.ndarray, langs: list[str], landmark: np.ndarray, ridge: float = RIDGE,
        block: int = FIT_ROWS) -> Model:
    """``bits``: rows of packed presence bits; ``landmark``: which of them are
    landmarks. Rows are unpacked a block at a time: what is held are the bits,
    the landmarks and a few squares of their number."""
    names, code = np.unique(np.array(langs), return_inverse=True)
    marks = unit_rows(bits[landmark])
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = value > 1e-7 * max(value.max(), 1e-12)              # single precision's noise is below
    root = vector[:, kept] / np.sqrt(value[kept])              # the kernel's inverse square root
    size, n = root.shape[1], len(bits)
    square, cross, total = np.zeros((size, size)), np.zeros((size, len(names))), np.zeros(size)
    for i in range(0, n, block):
        features = (unit_rows(bits[i:i + block]) @ marks.T).astype(np.float64) @ root
        square += features.T @ features
        total += features.sum(axis=0)
        cross += features.T @ (code[i:i + block, None] == np.arange(len(names)))
    middle, share = total / n, np.bincount(code, minlength=len(names)) / n
    solved = np.linalg.solve(square - n * np.outer(middle, middle) + ridge * n * np.eye(size),
                             cross - n * np.outer(middle, share))
    return Model(names.tolist(), marks.T @ (root @ solved).astype(np.float32),
                 (share - middle @ solved).astype(np.float32))


def sample(docs: DataFrame, per_lang: int = TRAIN_PER_LANG, landmarks: int = LANDMARKS_PER_LANG,
           total: int = TRAIN_TOTAL, total_landmarks: int = LANDMARKS_TOTAL) -> tuple[list, int]:
    """Rows (lang, turn, at) of different texts that may be learned from (see
    ``learnable``), of every language one at least, and how many of each
    language are landmarks. Texts are told apart by a hash and chosen by it, so
    neither a hot id nor a hot text adds rows."""
    labelled = (docs.filter(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
                .select("lang", "text", F.xxhash64("text").alias("same")))
    texts = stage(labelled.select("lang", "same").distinct(), "langid-texts")
    sizes = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}       # a number per language
    per_lang = max(1, min(per_lang, total // max(len(sizes), 1)))
    landmarks = max(1, min(landmarks, total_landmarks // max(len(sizes), 1)))
    chosen = first_by_hash(texts, "lang", sizes, per_lang, "langid", "same")

    @F.arrow_udf("binary")
    def features(texts: pa.Array) -> pa.Array:
        found = (presence(t) for t in texts.to_pylist())
        return pa.array([packed(at) if len(at) else None for at in found], pa.binary())

    # at most ``total`` hashes (or one per language) and as many rows of bits
    rows = (labelled.join(F.broadcast(chosen), ["lang", "same"])
            .groupBy("lang", "turn").agg(F.min("text").alias("text"))
            .select("lang", "turn", features("text").alias("at")).filter("at IS NOT NULL").collect())
    return sorted(rows, key=lambda r: (r["lang"], r["turn"])), landmarks


def train(docs: DataFrame, *bounds: int, **settings: int) -> Model | None:
    """Fits on ``sample(docs, ...)``; None if it is empty."""
    rows, landmarks = sample(docs, *bounds, **settings)
    if not rows:
        return None
    return fit(np.frombuffer(b"".join(r["at"] for r in rows), np.uint8).reshape(len(rows), -1),
               [r["lang"] for r in rows], np.array([r["turn"] <= landmarks for r in rows]))


# ----------------------------------------------------------------- operator

def identify(docs: DataFrame, model: Model | None, batch: int = 256) -> DataFrame:
    """``docs`` (column text; any others stay) with ``lang_pred`` and
    ``score``: the language whose regression gives the largest value (ties:
    the first by name) and that value, cut to 0..1. Texts that are null or
    have no letter, and all texts if there is no model, are ``und`` with score
    0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # BUCKETS * languages numbers

    @F.arrow_udf("lang_pred: string, score: double")
    def run(texts: pa.Array) -> pa.Array:
        fitted = shared.value
        names, values = [], []
        for i in range(0, len(texts), batch):
            rows = [presence(t) for t in texts[i:i + batch].to_pylist()]
            if fitted is None:
                names += [UNKNOWN] * len(rows)
                values += [0.0] * len(rows)
                continue
            scores = fitted.scores(rows)
            best = scores.argmax(axis=1)
            for row, k, s in zip(rows, best.tolist(), scores.max(axis=1).tolist()):
                names.append(fitted.langs[k] if len(row) else UNKNOWN)
                values.append(s if len(row) else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())],
                                          ["lang_pred", "score"])

    found = fresh("lang")
    return docs.withColumn(found, run("text")).withColumns(
        {"lang_pred": F.col(found)["lang_pred"], "score": F.col(found)["score"]}).drop(found)


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id,
    text, lang), by a model fitted on the rows of it that may be learned from.
    Null ids are not held out and not learned from; repeated rows get the same
    result; an empty table gives none."""
    model = train(docs.select("doc_id", "lang", "text"))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
