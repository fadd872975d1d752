"""Exact substring deduplication by super-k-mer partitioning.

A window is ``window`` consecutive words of a document. Its minimiser is the
smallest hash among its runs of ``MINIMISER`` words, so equal windows share
it wherever they occur; consecutive windows that share a minimiser travel to
the minimiser's bucket as one packed string of words (a super-k-mer). There a
sort brings equal windows together, their words are compared, and every
window but the earliest marks its words for removal.

* Texts are worked on as arrays of bytes: words are found, hashed and cut out
  for a whole batch at once. A packed string is its words as they are, each
  followed by one space; the strings of a batch for a bucket are one
  compressed row.
* Nothing is decided by hash alone: the words of windows that seem equal are
  compared byte by byte, and if two words share a hash the bucket is done
  again with words numbered one by one.
* Before the shuffle a batch sends a string that it holds several times only
  once, for its earliest place; all other places are wholly repeated and are
  marked on the spot. Thousands of copies thus reach a bucket as one row per
  batch.
* A bucket has ``FINE`` parts by minimiser. A large batch sends a row per part;
  a bucket's rows are sorted by part, so a task holds a few parts at a time and
  unpacks a row once. (A small batch sends one row per bucket.) Parts that are
  too large are worked off in passes over their minimisers. A single minimiser
  with too many different strings is dealt out again by the hash of the window
  itself, in a second round, each window once per slice of the first.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import fresh, shuffle_tasks, stage

WINDOW = 20
MINIMISER = 3
BATCH_BYTES = 8 << 20
PASS_WORDS = 2_000_000
HOT_WORDS = 1_000_000
#: Parts of a bucket, and words of neighbouring parts that are solved together.
FINE = 64
GROUP_WORDS = 500_000
#: A batch sends rows per part if they hold this many words on average.
ROW_WORDS = 64

_NO_ID = -(1 << 63)
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_SHIP = "part int, fine int, words bigint, data binary, did bigint, uid bigint, cuts binary"
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words beyond this many bytes are hashed one by one; slices that are hashed
#: or copied at once.
LONG_WORD, SLICE_WORDS, SLICE_BYTES = 1024, 50_000, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(LONG_WORD, _BASE))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions first[i], first[i] + 1, ... (count[i] of them), in turn."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - ends + count, count)


def run_hashes(word: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive words, by doubling."""
    out, done, power, size = None, 0, word, 1
    while done < length:
        if length & size:
            n = len(word) - length + 1
            part = power[done:done + max(n, 0)]
            out = part if out is None else _pair(out, part)
            done += size
        if done < length:
            power = _pair(power[:max(len(power) - size, 0)], power[size:])
            size *= 2
    return out


HASH_WORDS = 250_000


def windows_at(value: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the windows that begin at the words ``at`` (ascending);
    ``value`` is the hash of each word. Worked off in slices, so that only the
    result is as long as ``at``."""
    out = np.empty(len(at), np.uint64)
    done = 0
    while done < len(at):
        to = int(np.searchsorted(at, at[done] + HASH_WORDS))
        first = at[done]
        out[done:to] = run_hashes(value[first:at[to - 1] + window], window)[at[done:to] - first]
        done = to
    return out


def sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    size, best = 1, values
    while 2 * size <= length:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    rest = length - size
    return np.minimum(best[:len(best) - rest], best[rest:]) if rest else best


# ------------------------------------------------------------- words as bytes

def word_hashes(text: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word text[first:after]: its bytes times the
    powers of an odd number, with its length, mixed."""
    out = np.empty(len(first), np.uint64)
    size = after - first
    short = np.minimum(size, LONG_WORD)
    for a in range(0, len(first), SLICE_WORDS):
        n = short[a:a + SLICE_WORDS]
        ends = np.cumsum(n)
        place = np.arange(int(ends[-1])) - np.repeat(ends - n, n)
        terms = text[place + np.repeat(first[a:a + SLICE_WORDS], n)].astype(np.uint64) * _POWERS[place]
        out[a:a + SLICE_WORDS] = np.add.reduceat(terms, ends - n)
    out = _mix(out + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        out[i] = xxhash.xxh64_intdigest(text[first[i]:after[i]].tobytes())
    return out


def copied(text: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches text[at:at + size], one after the other."""
    ends, done, out = np.cumsum(size), 0, []
    while done < len(at):
        to = max(done + 1, int(np.searchsorted(ends, ends[done] - size[done] + SLICE_BYTES)))
        out.append(text[_spread(at[done:to], size[done:to])] if to > done + 1 else text[at[done]:at[done] + size[done]])
        done = to
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def same_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> bool:
    """Whether text[a:a + size] equals text[b:b + size] throughout."""
    for i in range(0, len(a), SLICE_WORDS):
        s = slice(i, i + SLICE_WORDS)
        if not np.array_equal(copied(text, a[s], size[s]), copied(text, b[s], size[s])):
            return False
    return True


# -------------------------------------------------------------- packed rows

class Packs:
    """Packed strings as flat arrays: where each lies in ``text`` (``at``,
    ``size`` in bytes), its ``length`` in words, key (minimiser) and place
    (document ``did``, ``uid``; first word ``start``)."""

    FIELDS = ("at", "size", "length", "key", "did", "uid", "start")
    KINDS = (np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64, np.int64)

    def __init__(self, text: np.ndarray, *columns: np.ndarray):
        self.text = text
        for name, column, kind in zip(self.FIELDS, columns, self.KINDS):
            setattr(self, name, column.astype(kind, copy=False))

    def take(self, rows) -> "Packs":
        return Packs(self.text, *[getattr(self, f)[rows] for f in self.FIELDS])

    def compact(self) -> "Packs":
        """The same strings, one after the other and nothing else in ``text``."""
        own = self.take(slice(None))
        own.text, own.at = copied(self.text, self.at, self.size), np.cumsum(self.size) - self.size
        return own

    def dump(self) -> bytes:
        raw = pickle.dumps((copied(self.text, self.at, self.size), self.size.astype(np.uint32), self.length.astype(np.uint32),
                            self.key, self.did, self.uid, self.start.astype(np.uint32)), 5)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def load(rows: Iterable[tuple]) -> Packs:
    """The packed strings of several rows, compact; ``rows`` are pairs of a
    blob and a function that picks keys (None: all)."""
    texts, columns = [], [[] for _ in Packs.FIELDS[1:]]
    for blob, wanted in rows:
        blob = memoryview(blob)
        raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
        text, size, *rest = pickle.loads(raw)
        size = size.astype(np.int64)
        packs = Packs(text, np.cumsum(size) - size, size, *rest)
        if wanted is not None:
            packs = packs.take(np.flatnonzero(wanted(packs.key))).compact()
        texts.append(packs.text)
        for column, name in zip(columns, Packs.FIELDS[1:]):
            column.append(getattr(packs, name))
    size, *rest = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns)
    return Packs(np.concatenate(texts) if texts else np.zeros(0, np.uint8), np.cumsum(size) - size, size, *rest)


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    """A key's part: bucket times ``FINE`` plus its part of the bucket."""
    return (key % np.uint64(parts * FINE)).astype(np.int64)


def _ship(packs: Packs, parts: int, row_words: float = ROW_WORDS) -> Iterator[tuple]:
    """One row per part of a bucket, or per bucket where those were tiny."""
    fine = _part(packs.key, parts)
    rough = packs.length.sum() < row_words * parts * FINE
    if rough:
        fine //= FINE
    order = np.argsort(fine, kind="stable")
    fine = fine[order]
    cuts = np.flatnonzero(np.diff(fine)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fine)]):
        if a < b:
            own, at = packs.take(order[a:b]), int(fine[a])
            yield (*((at, None) if rough else (at // FINE, at)), int(own.length.sum()), own.dump(), None, None, None)


def _marks(did: np.ndarray, uid: np.ndarray, start: np.ndarray, length: np.ndarray, parts: int) -> Iterator[tuple]:
    """One row per document: its repeated stretches, merged."""
    order = np.lexsort((start, uid, did))
    did, uid, start, end = did[order], uid[order], start[order], (start + length)[order]
    new = np.ones(len(did), bool)
    new[1:] = (did[1:] != did[:-1]) | (uid[1:] != uid[:-1])
    first = np.flatnonzero(new)
    for a, b in zip(first, np.append(first[1:], len(did))):
        reach = np.maximum.accumulate(end[a:b])
        apart = np.append(True, start[a + 1:b] > reach[:-1])
        tail = np.append(np.flatnonzero(apart)[1:] - 1, b - a - 1)
        cuts = np.stack([start[a:b][apart], reach[tail]], 1).astype(np.uint32)
        yield abs(int(did[a]) ^ int(uid[a])) % parts, None, 0, None, int(did[a]), int(uid[a]), cuts.tobytes()


def _batch(rows: Iterable[tuple], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Rows as they come, in record batches."""
    schema = pa.schema([("part", pa.int32()), ("fine", pa.int32()), ("words", pa.int64()), ("data", pa.binary()), ("did", pa.int64()),
                        ("uid", pa.int64()), ("cuts", pa.binary())])
    held = []

    def sent():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield sent()
            held = []
    if held:
        yield sent()


# --------------------------------------------------------------- before the shuffle

def _words_of(docs: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, each followed by one space, as bytes; where
    each begins and ends there; and the number of the document it is from."""
    raw = np.frombuffer(b"\n".join([d[2] for d in docs]) + b"\n", np.uint8)
    space = _SPACE[raw]
    after_space = np.append(True, space[:-1])
    begins = np.flatnonzero(after_space & ~space)
    text = np.where(space, np.uint8(32), raw)[~(space & after_space)]
    after = np.flatnonzero(text == 32)
    ends = np.cumsum(np.array([len(d[2]) + 1 for d in docs]))
    return text, np.append(0, after[:-1] + 1)[:len(after)], after, np.searchsorted(ends, begins, side="right")


def _repeated(code: np.ndarray, packs: Packs) -> np.ndarray:
    """Strings that equal an earlier one, by code and then byte by byte."""
    order = np.argsort(code, kind="stable")
    new = np.append(True, code[order][1:] != code[order][:-1])
    leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out = np.zeros(len(code), bool)
    whole = packs.text.tobytes()
    at, size = packs.at, packs.size
    for i, j in zip(order[~new].tolist(), leader[~new].tolist()):
        out[i] = whole[at[i]:at[i] + size[i]] == whole[at[j]:at[j] + size[j]]
    return out


def pack(docs: list[tuple[int, int, bytes]], window: int) -> tuple[Packs | None, list[np.ndarray]]:
    """Super-k-mers of a batch of (did, uid, text), and the marks
    (did, uid, start, length) of strings the batch holds more than once."""
    docs = sorted(docs, key=lambda d: d[:2])
    text, begin, after, owner = _words_of(docs)
    windows = len(begin) - window + 1
    if windows < 1:
        return None, []
    place = _spread(np.zeros(len(docs), np.int64), np.bincount(owner, minlength=len(docs)))
    word = word_hashes(text, begin, after)
    grain = min(MINIMISER, window)
    least = sliding_min(run_hashes(word, grain), window - grain + 1)
    valid = owner[:windows] == owner[window - 1:]
    new = valid.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1] | (owner[1:windows] != owner[:windows - 1])
    first = np.flatnonzero(new)
    if not len(first):
        return None, []
    length = np.bincount(np.cumsum(new)[valid] - 1, minlength=len(first)) + window - 1
    at = begin[first]
    did = np.array([d[0] for d in docs], np.int64)[owner[first]]
    uid = np.array([d[1] for d in docs], np.int64)[owner[first]]
    packs = Packs(text, at, after[first + length - 1] + 1 - at, length, _mix(least[first]), did, uid, place[first])
    # a string's earliest place counts: documents and places come in order
    sums = np.append(np.uint64(0), np.cumsum(word * _powers(len(word), _BASE)))
    code = (sums[first + length] - sums[first]) * _powers(len(word), _INVERSE)[first] + length.astype(np.uint64)
    again = _repeated(code, packs)
    marks = [x[again] for x in (packs.did, packs.uid, packs.start, packs.length)]
    return packs.take(np.flatnonzero(~again)), marks


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """1, base, base ** 2 ..., modulo 2 ** 64."""
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out)


def _pack_rows(window: int, parts: int, batch_bytes: int, row_words: float):
    def run(batches):
        def rows(docs):
            # equal (id, text) rows are one document
            packs, marks = pack(list({d[:2]: d for d in docs}.values()), window)
            if packs is not None:
                yield from _ship(packs, parts, row_words)
                yield from _marks(*marks, parts)

        docs, held = [], 0
        for batch in batches:
            did, uid, text = (batch.column(i) for i in range(3))
            for d, u, t in zip(did.to_pylist(), uid.to_pylist(), text):
                t = t.as_py()
                if t:
                    docs.append((d, u, t))
                    held += len(t)
                if held >= batch_bytes:
                    yield from _batch(rows(docs))
                    docs, held = [], 0
        if docs:
            yield from _batch(rows(docs))
        pa.default_memory_pool().release_unused()             # workers are used again by other stages

    return run


# ---------------------------------------------------------------- in a bucket

def _numbers(text: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A value per word that only equal words share."""
    number: dict[bytes, int] = {}
    whole = text.tobytes()
    words = (number.setdefault(whole[a:b], len(number) + 1) for a, b in zip(first.tolist(), after.tolist()))
    return np.fromiter(words, np.uint64, len(first)) * np.uint64(0xA24BAED4963EE407)


def windows_of(packs: Packs, window: int, hashes=word_hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """All windows of compact ``packs``: their first words, their strings,
    whether their words also occur at an earlier place among ``packs``; and
    (first byte, byte after) of all words."""
    after = np.flatnonzero(packs.text == 32)
    first = np.append(0, after[:-1] + 1)[:len(after)]
    begin = np.cumsum(packs.length) - packs.length
    count = packs.length - window + 1
    at = _spread(begin, count)
    string = np.repeat(np.arange(len(count)), count)
    later = np.zeros(len(at), bool)
    if not len(at):
        return at, string, later, (first, after)
    value = hashes(packs.text, first, after)
    code = windows_at(value, at, window)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    shared = np.append(False, same) | np.append(same, False)
    rows = order[shared]                                  # windows that share their hash
    if not len(rows):
        return at, string, later, (first, after)
    if hashes is not _numbers:
        # words of these windows that share a hash must be equal
        cover = np.cumsum(np.bincount(at[rows], minlength=len(first) + 1) - np.bincount(at[rows] + window, minlength=len(first) + 1))
        word = np.flatnonzero(cover[:-1] > 0)
        word = word[np.argsort(value[word], kind="stable")]
        twin = np.flatnonzero(value[word][1:] == value[word][:-1])
        a, b, size = word[twin], word[twin + 1], after - first
        if (size[a] != size[b]).any() or not same_bytes(packs.text, first[a], first[b], size[a]):
            return windows_of(packs, window, _numbers)
    group = np.cumsum(np.append(True, np.diff(code[rows]) != 0)) - 1
    group = _by_words(value, at[rows], group, window)
    of = string[rows]
    did, uid = packs.did[of], packs.uid[of]
    start = packs.start[of] + at[rows] - begin[of]
    order = np.lexsort((start, uid, did, group))
    group, did, uid, start = group[order], did[order], uid[order], start[order]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    of = np.repeat(head, np.diff(np.append(head, len(group))))
    # rows that repeat both id and text are one document: not a repetition
    later[rows[order]] = (did != did[of]) | (uid != uid[of]) | (start != start[of])
    return at, string, later, (first, after)


def _by_words(ids: np.ndarray, at: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Splits groups of equal hash by their words (they differ only in a hash
    collision); groups are consecutive."""
    head = np.flatnonzero(np.append(True, np.diff(group) != 0))
    leader = np.repeat(at[head], np.diff(np.append(head, len(group))))
    differs = np.zeros(len(at), bool)
    for k in range(window):
        differs |= ids[at + k] != ids[leader + k]
    if not differs.any():
        return group
    rows = np.flatnonzero(np.isin(group, np.unique(group[differs])))
    words = np.unique(ids[at[rows][:, None] + np.arange(window)], axis=0, return_inverse=True)[1]
    group = group.copy()
    group[rows] = group.max() + 1 + words.reshape(-1)
    return group


def _solved(packs: Packs, window: int, parts: int, deal_again: bool) -> Iterator[tuple]:
    """Marks of the repeated windows; with ``deal_again`` the other windows as
    strings of their own, dealt by window."""
    at, string, later, (first, after) = windows_of(packs, window)
    begin = np.cumsum(packs.length) - packs.length

    def starts(rows):
        return packs.start[string[rows]] + at[rows] - begin[string[rows]]

    gone = np.flatnonzero(later)
    yield from _marks(packs.did[string[gone]], packs.uid[string[gone]], starts(gone), np.full(len(gone), window, np.int64), parts)
    if deal_again:
        left = np.flatnonzero(~later)
        code = windows_at(word_hashes(packs.text, first, after), at[left], window)
        for i in range(0, len(left), 50_000):
            rows = left[i:i + 50_000]
            a, s = at[rows], string[rows]
            yield from _ship(Packs(packs.text, first[a], after[a + window - 1] + 1 - first[a], np.full(len(a), window), code[i:i + 50_000],
                                   packs.did[s], packs.uid[s], starts(rows)), parts)


def _solve_bucket(window: int, parts: int, pass_words: int, hot_words: int | None, group_words: int = GROUP_WORDS):
    """``hot_words`` None: no key is dealt out again."""

    def solve(blobs, rough, words, low, high):
        """The parts low .. high - 1 of a bucket: their own rows and what the
        rows of the whole bucket have for them."""
        passes = max(1, -(-int(words) // pass_words))
        for p in range(passes):
            def mine(key, p=p):
                return key // np.uint64(parts * FINE) % np.uint64(passes) == p

            def within(key, mine=mine):
                part = _part(key, parts) % FINE
                return (part >= low) & (part < high) & mine(key)

            whole = passes == 1
            packs = load([(b, None if whole else mine) for b in blobs]
                         + [(b, None if whole and high - low == FINE else within) for b in rough])
            if hot_words is not None and packs.length.sum() > hot_words:
                keys, of = np.unique(packs.key, return_inverse=True)
                hot = np.bincount(of, packs.length)[of] > hot_words
                if hot.any():
                    rows = np.flatnonzero(hot)
                    slices = np.cumsum(packs.length[rows]) // hot_words
                    for n in np.unique(slices):
                        yield from _solved(packs.take(rows[slices == n]).compact(), window, parts, True)
                    packs = packs.take(np.flatnonzero(~hot)).compact()
            yield from _solved(packs, window, parts, False)

    def run(batches):
        rough, rough_words, blobs, words, low, part = [], 0, [], 0, 0, 0
        for batch in batches:
            through = batch.filter(pa.compute.is_null(batch.column(3)))
            if through.num_rows:
                yield through
            for fine, n, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if not data.is_valid:
                    continue
                if fine is None:                              # sorted first
                    rough.append(data.as_buffer())            # no copy
                    rough_words += n
                    continue
                fine %= FINE
                share = rough_words * (fine - low) / FINE
                if fine != part and words + share >= group_words:
                    yield from _batch(solve(blobs, rough, words + share, low, fine))
                    blobs, words, low = [], 0, fine
                part = fine
                blobs.append(data.as_buffer())
                words += n
        if blobs or rough:
            yield from _batch(solve(blobs, rough, words + rough_words * (FINE - low) / FINE, low, FINE))
        pa.default_memory_pool().release_unused()

    return run


# ------------------------------------------------------------------ operator

def repeated_stretches(docs: DataFrame, window: int = WINDOW, *, pass_words: int = PASS_WORDS,
                       hot_words: int = HOT_WORDS, batch_bytes: int = BATCH_BYTES,
                       row_words: float = ROW_WORDS, group_words: int = GROUP_WORDS) -> DataFrame:
    """(did, uid, cuts): per document with repeated windows its stretches of
    words to remove, as pairs of unsigned 32-bit (first, after last). ``docs``
    has ``did``, ``uid`` and ``text`` (binary)."""
    parts = shuffle_tasks(docs.sparkSession)
    rows = docs.mapInArrow(_pack_rows(window, parts, batch_bytes, row_words), _SHIP)
    done, hot = [], hot_words
    while True:
        solved = stage(rows.repartitionById(parts, F.col("part")).sortWithinPartitions("fine")
                       .mapInArrow(_solve_bucket(window, parts, pass_words, hot, group_words), _SHIP), "substring")
        done.append(solved.filter("data IS NULL"))
        again = solved.filter("data IS NOT NULL")
        if hot is None or again.isEmpty():
            break
        rows, hot = again, None
    marks = done[0] if len(done) == 1 else done[0].unionByName(done[1])
    return marks.groupBy("did", "uid").agg(F.collect_list("cuts").alias("cuts"))


def _removed(cuts: list[bytes] | None, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for pairs in cuts or ():
        pairs = np.frombuffer(pairs, np.uint32).reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, pairs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def without(text: bytes, removed: np.ndarray) -> bytes:
    """``text`` without its removed words and the space that follows each;
    kept words keep theirs, so lines survive."""
    begins = [m.start() for m in _WORDS.finditer(text)] + [len(text)]
    return b"".join(text[a:b] for a, b, gone in zip(begins, begins[1:], removed.tolist()) if not gone).rstrip()


def dedup(docs: DataFrame, name: str, window: int = WINDOW, **limits) -> DataFrame:
    """``docs`` (columns doc_id, text; any others stay) with a struct column
    ``name``: n_words, n_removed, kept_sha256 (of the kept words joined by one
    space) and text (unchanged if no word goes, else without the removed
    words).

    A word goes if a window that covers it also starts earlier: in a document
    of smaller id, or earlier in the same one. Null ids come first. Documents
    of equal id are ordered by a hash of their texts; rows that repeat both
    id and text are one document and get the same result. Null texts have no
    words and stay null; texts shorter than a window lose nothing.
    """
    did, uid, cuts = fresh("did"), fresh("uid"), fresh("cuts")
    keyed = docs.withColumns({did: F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
                              uid: F.xxhash64("text")})
    marks = repeated_stretches(
        keyed.select(F.col(did).alias("did"), F.col(uid).alias("uid"), F.col("text").cast("binary").alias("text")),
        window, **limits)
    marks = stage(marks, "substring-marks").select(
        F.col("did").alias(did), F.col("uid").alias(uid), F.col("cuts").alias(cuts))

    @F.arrow_udf("n_words: bigint, n_removed: bigint, kept_sha256: string, text: string")
    def apply(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for text, pairs in zip(texts, found):
            raw, pairs = text.as_py(), pairs.as_py()
            words = (raw or b"").split()
            if not pairs:
                kept, new = words, raw
            else:
                removed = _removed(pairs, len(words))
                kept = [w for w, gone in zip(words, removed.tolist()) if not gone]
                new = without(raw, removed)
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(),
                         None if new is None else new.decode()))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = zip(*rows) if rows else [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          ["n_words", "n_removed", "kept_sha256", "text"])

    return (keyed.join(marks, [did, uid], "left")
            .withColumn(name, apply(F.col("text").cast("binary"), F.col(cuts)))
            .drop(did, uid, cuts))


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated windows cut from ``text``; all rows stay."""
    name = fresh("dedup")
    done = dedup(docs, name, window)
    return done.select(*[F.col(name)["text"].alias("text") if c == "text" else F.col(c) for c in docs.columns])
