"""Byte-level BPE by speculate and verify.

For the distinct words a batch adds, greedy longest match proposes tokens.
A sequence is the merge result exactly if every adjacent pair is *compatible*:
merging the two tokens' own bytes gives just these two tokens back. The pairs
of all proposed words are looked up at once in sorted arrays of pairs judged
before (by exact merging, once each); words with an incompatible pair, and
only these, are merged exactly. A word's ids are kept as bytes, so a text is
encoded by joining its words' entries.

The tokenizer file is read on the driver from a path given as a parameter and
broadcast as bytes (its size is fixed, some MB); a worker parses it once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_CHARS = 2_000_000
CACHED_WORDS = 200_000
ROWS_AT_ONCE = 1_000
SHORT_WORD = 48
KNOWN_PAIRS = 4_000_000

#: The word pattern of byte-level BPE files, in full and, for
#: texts below U+0250, with its letters (L), numbers (N) and spaces (S) listed.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
LATIN = {"L": "A-Za-zªµºÀ-ÖØ-öø-ɏ", "N": "0-9²³¹¼½¾", "S": "\t-\r \x85\xa0"}
LATIN_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
                 ).format(**LATIN)

_words = regex.compile(PATTERN).findall
_latin_words = re.compile(LATIN_PATTERN).findall
_beyond_latin = re.compile("[^\x00-ɏ]").search


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(text: str) -> list[str]:
    return _words(text) if _beyond_latin(text) else _latin_words(text)


def byte_letters() -> list[str]:
    """The character that stands for each byte in vocabulary files: printable
    Latin-1 for itself, the others from U+0100 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class _Lookup:
    """A fixed table of integers, looked up for whole arrays."""

    def __init__(self, table: dict[int, int], default: int):
        self.keys = np.array(sorted(table), np.int64)
        self.values = np.array([table[k] for k in self.keys.tolist()], np.int64)
        self.default = default

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.default)


def _alike(words: list[bytes]) -> list[list[int]]:
    """Indices by length, in parts of similar length and bounded size."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    parts, at = [], 0
    while at < len(order):
        to, least = at, len(words[order[at]])
        while to < len(order) and to - at < 8192 and len(words[order[to]]) <= max(8, least + least // 4) and (
                least > SHORT_WORD or len(words[order[to]]) <= SHORT_WORD):
            to += 1
        parts.append(order[at:to])
        at = to
    return parts


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each word, zero-filled; sizes)"""
    width = max(map(len, words))
    flat = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8)
    return flat.reshape(len(words), width).astype(np.int64), np.fromiter(map(len, words), np.int64, len(words))


class Bpe:
    """One tokenizer file: its merges, and what a worker has learned."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        letters = byte_letters()
        value = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [b""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for word, i in model["vocab"].items():
            self.token[i] = bytes(value[c] for c in word)
        for word, i in self.special.items():
            self.token[i] = word.encode()
        self.byte = [model["vocab"][c] for c in letters]
        self.rank, self.new = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[model["vocab"][a], model["vocab"][b]] = rank
            self.new.append(model["vocab"][a + b])
        size = len(self.token)
        self.pairs = _Lookup({a * size + b: rank for (a, b), rank in self.rank.items()}, len(self.new))
        # states 0-255 are the single bytes; a step is keyed state << 8 | byte
        step, token_at = {}, list(self.byte)
        for i in model["vocab"].values():
            word = self.token[i]
            state = word[0]
            for byte in word[1:]:
                key = state << 8 | byte
                if (state := step.get(key)) is None:
                    state = step[key] = len(token_at)
                    token_at.append(-1)
            token_at[state] = i
        self.step, self.token_at = _Lookup(step, -1), np.array(token_at, np.int64)
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")"
                                ).split if self.special else (lambda text: [text])
        self.ids_of: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        self.good, self.bad = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merged(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging of each word: always the lowest rank, leftmost first."""
        out: list[list[int]] = [[]] * len(words)
        for rows in _alike(words):
            if len(words[rows[0]]) > SHORT_WORD:
                for i in rows:
                    out[i] = self._merged_long(words[i])
                continue
            ids, count = self._merged_short([words[i] for i in rows])
            for i, row, n in zip(rows, ids.tolist(), count.tolist()):
                out[i] = row[:n]
        return out

    def _merged_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """One merge per word and round, all words at a time."""
        text, count = _padded(words)
        size, none = len(self.token), len(self.new)
        new = np.array(self.new + [0])
        ids = np.where(np.arange(text.shape[1] + 1) < count[:, None],
                       np.array(self.byte)[np.pad(text, ((0, 0), (0, 1)))], -1)
        def rank_of(left, right):
            return np.where((left >= 0) & (right >= 0), self.pairs(left * size + right), none)
        rank = rank_of(ids[:, :-1], ids[:, 1:])
        out, rows = ids.copy(), np.arange(len(words))
        columns = np.arange(ids.shape[1])
        while True:
            at = rank.argmin(axis=1)
            least = rank[np.arange(len(rank)), at]
            going = least < none
            if not going.all():
                out[rows[~going]] = ids[~going]
                rows, ids, rank, at, least = rows[going], ids[going], rank[going], at[going], least[going]
            if not len(rows):
                return out, (out >= 0).sum(axis=1)
            each = np.arange(len(rows))
            shift = np.minimum(columns + (columns > at[:, None]), len(columns) - 1)
            ids = np.take_along_axis(ids, shift, 1)
            ids[:, -1] = -1
            ids[each, at] = new[least]
            rank = np.take_along_axis(rank, np.minimum(shift, len(columns) - 2)[:, :-1], 1)
            rank[:, -1] = none
            rank[each, at] = rank_of(ids[each, at], ids[each, at + 1])
            left = np.maximum(at - 1, 0)
            rank[each, left] = np.where(at > 0, rank_of(ids[each, left], ids[each, at]), rank[each, left])

    def _merged_long(self, word: bytes) -> list[int]:
        """The same with a heap of candidate merges, for one long word."""
        ids = [self.byte[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.new[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (got := self.rank.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (got, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def proposed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at a time: (ids, how many per
        word), a walk down the trie of tokens."""
        count = np.zeros(len(words), np.int64)
        owners, tokens = [], []
        for rows in _alike(words):
            text, size = _padded([words[i] for i in rows])
            text = np.pad(text, ((0, 0), (0, 1)))
            rows = np.array(rows)
            state = text[:, 0]
            last, end, upto = self.token_at[state], np.zeros_like(size), np.ones_like(size)
            while len(rows):
                each = np.arange(len(rows))
                state = np.where(upto < size, self.step(state << 8 | text[each, upto]), -1)
                token = np.where(state >= 0, self.token_at[state], -1)
                last, end = np.where(token >= 0, token, last), np.where(token >= 0, upto, end)
                upto = upto + 1
                stop = np.flatnonzero(state < 0)
                if len(stop):
                    owners.append(rows[stop])
                    tokens.append(last[stop])
                    at = end[stop] + 1
                    first = text[stop, np.minimum(at, size[stop])]
                    state[stop], last[stop], end[stop], upto[stop] = first, self.token_at[first], at, at + 1
                    if (at >= size[stop]).any():
                        on = np.ones(len(rows), bool)
                        on[stop[at >= size[stop]]] = False
                        rows, text, size, state, last, end, upto = (
                            x[on] for x in (rows, text, size, state, last, end, upto))
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        count += np.bincount(owner, minlength=len(words))
        return token[np.argsort(owner, kind="stable")], count

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each pair (left * size + right; alone: -1 - token) stays
        as it is under exact merging."""
        todo = np.setdiff1d(pairs, np.concatenate([self.good, self.bad]))
        if len(todo):
            kept = [[-1 - p] if p < 0 else [*divmod(p, len(self.token))] for p in todo.tolist()]
            found = self.merged([b"".join([self.token[i] for i in both]) for both in kept])
            right = np.array([a == b for a, b in zip(found, kept)])
            if len(self.good) + len(self.bad) > KNOWN_PAIRS:
                self._forget()
                return self.compatible(pairs) if len(todo) < len(pairs) else right[np.searchsorted(todo, pairs)]
            self.good, self.bad = np.union1d(self.good, todo[right]), np.union1d(self.bad, todo[~right])
        at = np.minimum(np.searchsorted(self.good, pairs), max(len(self.good) - 1, 0))
        return self.good[at] == pairs if len(self.good) else np.zeros(len(pairs), bool)

    def learn(self, words: list[str]) -> None:
        """Enters words into ``ids_of``: propose, verify, merge the failed."""
        raw = [w.encode() for w in words]
        flat, count = self.proposed(raw)
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(words)), count)
        inside = owner[1:] == owner[:-1]
        alone = np.flatnonzero(count == 1)
        pairs = np.concatenate([flat[:-1][inside] * len(self.token) + flat[1:][inside], -1 - flat[first[alone]]])
        distinct, which = np.unique(pairs, return_inverse=True)
        failed = np.zeros(len(words), bool)
        failed[np.concatenate([owner[1:][inside], alone])[~self.compatible(distinct)[which]]] = True
        data = flat.astype("<u4").tobytes()
        for word, a, n in zip(words, (4 * first).tolist(), (4 * count).tolist()):
            self.ids_of[word] = data[a:a + n]
        wrong = np.flatnonzero(failed).tolist()
        for i, ids in zip(wrong, self.merged([raw[i] for i in wrong])):
            self.ids_of[words[i]] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            held, to = 0, at
            while to < len(texts) and (to == at or held < BATCH_CHARS):
                held += len(texts[to])
                to += 1
            cut = [[p if p in self.special else pieces(p) for p in self.split(t)] for t in texts[at:to]]
            if len(self.ids_of) > CACHED_WORDS:             # words not met again are forgotten
                self.ids_of, self.older = {}, self.ids_of
            known, older = self.ids_of, self.older
            new = {w for parts in cut for p in parts if not isinstance(p, str) for w in p if w not in known}
            known.update((w, older[w]) for w in new if w in older)
            if new := [w for w in new if w not in older]:
                self.learn(new)
            get = known.__getitem__
            out += [b"".join(np.uint32(self.special[p]).astype("<u4").tobytes() if isinstance(p, str)
                             else b"".join(map(get, p)) for p in parts) for parts in cut]
            at = to
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")


_loaded: dict[str, Bpe] = {}


def loaded(data: bytes) -> Bpe:
    """The tokenizer of these bytes, parsed once per worker."""
    name = hashlib.sha1(data).hexdigest()
    if name not in _loaded:
        _loaded[name] = Bpe(data)
    return _loaded[name]


def broadcast_tokenizer(spark: SparkSession, path: str | None = None) -> Broadcast:
    with open(path or default_path(), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``docs`` (column text; any others stay) with a binary column ``name``:
    the ids of the whole text as little-endian unsigned 32-bit integers.
    Special tokens' strings in a text become their ids; none are added. Null
    and empty texts have no ids."""
    shared = broadcast_tokenizer(docs.sparkSession, path)

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(loaded(shared.value).encode([t or "" for t in texts.to_pylist()]), pa.binary())

    return docs.withColumn(name, run(F.col("text")))


def decoded(rows: DataFrame, ids: str, name: str, path: str | None = None) -> DataFrame:
    """``rows`` with a string column ``name``: the text of the ids in column
    ``ids`` (null: empty); invalid UTF-8 becomes U+FFFD."""
    shared = broadcast_tokenizer(rows.sparkSession, path)

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        bpe = loaded(shared.value)
        return pa.array([bpe.decode(i or b"") for i in column.to_pylist()], pa.string())

    return rows.withColumn(name, run(F.col(ids)))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row: the text is
    encoded, its ids are decoded again, both are digested. Repeated rows and
    null ids are rows like any other; no rows in, none out."""
    shared = broadcast_tokenizer(docs.sparkSession, path)

    def run(batches):
        bpe = loaded(shared.value)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(at, ROWS_AT_ONCE)
                    ids = bpe.encode([t or "" for t in part.column(1).to_pylist()])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                         pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                         pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids], pa.string())],
                        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            # workers are used again by other stages: known words go with the task
            bpe.ids_of, bpe.older = {}, {}
            pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
