"""Quality rules as weak supervision.

Rules look at a document's measures and vote good, bad or abstain. Nobody
tells them apart from the outside: expectation-maximisation over the votes of
all documents estimates how often each rule's vote is right, and a document's
posterior quality probability decides, instead of demanding that every rule
passes.

The data enters the estimation only as counts per vote pattern, at most
3**rules numbers whatever the corpus size, gathered by one aggregation over
all documents.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import fresh, stage

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_span_words", "n_span_distinct", "n_short_words", "n_sentence_ends", "n_symbol_words")

#: Distinct words are counted in spans of so many words: their share in a whole
#: text falls with its length.
SPAN = 500

_KIND = np.zeros(256, np.uint8)
_KIND[list(SYMBOLS)] = 1
_KIND[list(SPACES)] = 2
_KIND[0x80:0xC0] = 3                     # continuation bytes: no code point of their own


def measures(text: bytes | None) -> tuple[int, ...]:
    """The measures of one whole text, given in UTF-8 (null: all 0)."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    n = len(words)
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=4)
    seen: set[bytes] = set()
    n_lines = dup = 0
    for line in text.split(b"\n"):
        if line.strip():
            n_lines += 1
            if line in seen:
                dup += 1
            seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    short = sum(len(w) <= 3 or (len(w) <= 12 and not w.isascii() and len(w.decode("utf-8", "replace")) <= 3)
                for w in words)
    enders = sum(w.endswith((b".", b"!", b"?")) for w in words)
    symbol_words = sum(w[-1] in SYMBOLS for w in words)
    return (n, len(text) - int(kinds[2]) - int(kinds[3]), int(kinds[1]), dup, repeated_words(ids),
            n_lines, *distinct_words(ids), short, enders, symbol_words)


def distinct_words(ids: np.ndarray) -> tuple[int, int]:
    """(words, distinct words) summed over spans that cover the whole text: one
    after the other, the last ends with the text; a shorter text is one."""
    if len(ids) <= SPAN:
        return len(ids), len(np.unique(ids))
    at = np.arange(0, len(ids) - SPAN + 1, SPAN)
    if at[-1] + SPAN < len(ids):
        at = np.append(at, len(ids) - SPAN)
    spans = np.sort(ids[at[:, None] + np.arange(SPAN)], axis=1)
    return spans.size, len(spans) + int((spans[:, 1:] != spans[:, :-1]).sum())


def repeated_words(ids: np.ndarray) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    window = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]      # exact below 2**21 distinct words
    if size >= 1 << 21:
        window = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True)[1]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(window) + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    twice = twice[:-1]
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k:len(ids) - 2 + k] |= twice
    return int(covered.sum())


def measured(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the measures of ``text`` in a struct column ``name``."""

    @F.arrow_udf(", ".join(f"{m}: bigint" for m in MEASURES))
    def run(texts: pa.Array) -> pa.Array:
        rows = [measures(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))], list(MEASURES))

    return docs.withColumn(name, run(F.col("text").cast("binary")))


# -------------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    """Votes on one ratio: good inside ``good``, bad outside ``fair``, else it
    abstains; ``applies`` says where it has a say at all."""

    name: str
    ratio: Callable[[Column], Column]
    good: tuple[float, float]
    fair: tuple[float, float]
    applies: Callable[[Column], Column] = lambda m: m["n_words"] >= 20

    def vote(self, m: Column) -> Column:
        """1 good, 0 abstain, -1 bad."""
        r = self.ratio(m)
        return F.when(~self.applies(m), 0).when(r.between(*self.good), 1).when(
            r.between(*self.fair), 0).otherwise(-1)


def _per_word(name: str) -> Callable[[Column], Column]:
    return lambda m: m[name] / F.greatest(m["n_words"], F.lit(1))


def _repeated(m: Column) -> Column:
    """Repeated words per word, in units of what clean prose may have: twice as
    much at 20,000 words as up to 2,000, and so on, as windows recur by chance."""
    return _per_word("n_repeat_words")(m) / F.greatest(F.lit(1.0), 1 + F.log10(m["n_words"] / F.lit(2000.0)))


RULES = (
    Rule("word_length", _per_word("word_chars"), (4.0, 6.5), (3.5, 7.5)),
    Rule("symbols", _per_word("n_symbols"), (0.0, 0.03), (0.0, 0.15)),
    Rule("symbol_words", _per_word("n_symbol_words"), (0.0, 0.03), (0.0, 0.2)),
    Rule("repeated_windows", _repeated, (0.0, 0.15), (0.0, 0.4)),
    Rule("distinct_words", lambda m: m["n_span_distinct"] / F.greatest(m["n_span_words"], F.lit(1)), (0.5, 1.0), (0.25, 1.0)),
    Rule("short_words", _per_word("n_short_words"), (0.15, 0.42), (0.08, 0.48)),
    Rule("sentence_ends", _per_word("n_sentence_ends"), (0.02, 0.25), (0.01, 0.5),
         lambda m: m["n_words"] >= 50),
    Rule("repeated_lines", lambda m: m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)), (0.0, 0.2), (0.0, 0.5),
         lambda m: m["n_lines"] >= 3),
)


# --------------------------------------------------------------- estimation

@dataclass(frozen=True)
class Model:
    """``good_share``, and per rule the chance of each vote (bad, abstain,
    good) on bad and on good documents."""

    good_share: float
    votes: np.ndarray                    # (rules, 2 classes, 3 votes)

    def accuracies(self) -> np.ndarray:
        """How often a rule that votes is right."""
        share = np.array([1 - self.good_share, self.good_share])
        right = self.votes[:, 0, 0] * share[0] + self.votes[:, 1, 2] * share[1]
        return right / ((self.votes[:, :, 0] + self.votes[:, :, 2]) @ share)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0) -> Model:
    """EM over vote patterns (n, rules; -1, 0, 1) that occur ``counts`` times.

    Starts from "bad if any rule says bad" at 9 to 1 and stops when the good
    share moves by less than 1e-9. ``smooth`` documents are added to each vote
    cell, so a rule that never voted some way keeps a small chance of it. No
    documents: every vote is equally likely.
    """
    n_rules = patterns.shape[1]
    if not counts.sum():
        return Model(0.5, np.full((n_rules, 2, 3), 1 / 3))
    hot = np.eye(3)[patterns + 1]                                      # (n, rules, 3)
    good = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    share = -1.0
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])        # (2, n)
        cells = np.einsum("cn,nrv->rcv", weight, hot) + smooth
        votes = cells / cells.sum(axis=2, keepdims=True)
        before, share = share, float((weight[1].sum() + smooth) / (counts.sum() + 2 * smooth))
        logs = np.einsum("nrv,rcv->nc", hot, np.log(votes)) + np.log([1 - share, share])
        good = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if abs(share - before) < 1e-9:
            break
    return Model(share, votes)


def fit(votes: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """Estimates from all rows of ``votes`` (one column per rule): one
    aggregation, whose result has at most 3**rules rows."""
    names = [r.name for r in rules]
    found = votes.groupBy(*names).count().collect()
    return estimate(np.array([[r[n] for n in names] for r in found], np.int64).reshape(-1, len(names)),
                    np.array([r["count"] for r in found], float))


def posterior(m: Column, model: Model, rules: tuple[Rule, ...] = RULES) -> Column:
    """Probability of a good document given its votes."""
    odds = F.lit(float(np.log(model.good_share / (1 - model.good_share))))
    for rule, cells in zip(rules, model.votes):
        bad, none, good = (float(x) for x in np.log(cells[1] / cells[0]))
        vote = rule.vote(m)
        odds = odds + F.when(vote < 0, bad).when(vote > 0, good).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def base_failed(m: Column) -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def verdict(m: Column, model: Model, threshold: float = 0.5) -> Column:
    """Measures, ``base_failed``, ``good`` (the posterior probability) and
    ``kept`` of a struct of measures."""
    failed, good = base_failed(m), posterior(m, model)
    return F.struct(*[m[x].alias(x) for x in MEASURES], failed.alias("base_failed"), good.alias("good"),
                    (~failed & (good >= threshold)).alias("kept"))


def _votes(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*[r.vote(F.col(name)).alias(r.name) for r in RULES])


def judged(docs: DataFrame, name: str, threshold: float = 0.5) -> DataFrame:
    """``docs`` (column text; any others stay) with a struct column ``name``:
    the measures, ``base_failed``, ``good`` (the posterior probability) and
    ``kept``.

    Null, empty and wordless texts have all measures 0, fail the base rules
    and get abstentions only. Repeated rows are judged alike. An empty table
    gives an empty table. The rows and their measures are written once; hand
    over few columns beside the text.
    """
    rows = stage(measured(docs, name).drop("text"), "quality")
    return rows.withColumn(name, verdict(F.col(name), fit(_votes(rows, name)), threshold))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged. The votes of all
    rows are counted in a first pass, and a second one measures each text
    again and filters: a copy of all texts would cost more."""
    name = fresh("quality")
    model = fit(_votes(measured(docs.select("text"), name), name))
    return (measured(docs, name).withColumn(name, verdict(F.col(name), model, threshold))
            .filter(F.col(name)["kept"]).select(*docs.columns))
