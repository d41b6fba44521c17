"""Encoding of texts by a byte-level BPE vocabulary, with padded numpy matrices inside Arrow tasks."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Text of one pass through the masks and matrices.
PASS_BYTES = 4_000_000
#: Pieces of more bytes, texts without spaces, are merged by rank instead of in a matrix.
LONG_BYTES = 1_024

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
_NONE = np.int32(2**31 - 1)
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Unicode White_Space (fixed values).
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point: letter, number, white space, other."""
    c = np.zeros(0x110000, np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER}
    for i in (*range(0x32400), *range(0xE0000, 0xE0200)):
        c[i] = kinds.get(unicodedata.category(chr(i))[0], _OTHER)
    c[_WHITE] = _SPACE
    return c


class Vocabulary:
    """Byte ids, and the merges as a hash table from pairs of ids to rank and merged id."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        # byte-level vocabularies write each byte as a printable character: itself, or one from 256 on in order
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain}
        shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[shown[b]] for b in range(256)], np.int32)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.uint64)
        right = np.array([vocab[b] for _, b in merges], np.uint64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = (left << np.uint64(32)) | right
        self.bits = max(4, (4 * len(keys)).bit_length())  # at most a quarter of the table is filled
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(todo):
            free = self.ranks[slot] == _NONE
            _, one = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[one]
            self.keys[slot[put]] = keys[todo[put]]
            self.ranks[slot[put]] = todo[put]
            rest = np.ones(len(todo), bool)
            rest[put] = False
            todo, slot = todo[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _P) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; _NONE where they don't merge or an id is negative."""
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint32).astype(np.uint64)
        slot = self._slot(keys)
        out = np.full(len(keys), _NONE, np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        slot = slot[todo]
        for _ in range(self.probes):
            if not len(todo):
                break
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            go = ~hit & (self.ranks[slot] != _NONE)
            todo, slot = todo[go], (slot[go] + 1) & ((1 << self.bits) - 1)
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _pieces(b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The first bytes of the pieces that merges don't cross, of texts that follow one another in ``b``.

    As the pattern of the vocabulary reads: English contractions; a run of letters, of numbers or of other marks, each with one
    space before it; white space up to the last before something else; white space.
    """
    at = np.flatnonzero((b & 0xC0) != 0x80)
    x = b[at].astype(np.uint32)
    more = np.r_[b, np.zeros(3, np.uint8)].astype(np.uint32) & 0x3F
    cp = x.copy()
    for low, high, mask, n in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        m = np.flatnonzero((x >= low) & (x < high))
        v = x[m] & mask
        for k in range(1, n + 1):
            v = (v << np.uint32(6)) | more[at[m] + k]
        cp[m] = np.minimum(v, 0x10FFFF)
    kind = _classes()[cp]
    n = len(at)
    begin = np.zeros(n + 1, bool)
    starts = np.searchsorted(at, offsets[:-1][np.diff(offsets) > 0])
    begin[starts] = begin[n] = True
    prev, prev_cp = np.r_[_OTHER, kind[:-1]].astype(np.uint8), np.r_[0, cp[:-1]]
    space, was = kind == _SPACE, prev == _SPACE
    follows = np.r_[~space[1:], False] & ~begin[1:]  # something that is no space follows in the same text
    first = begin[:-1].copy()
    first |= ~space & np.where(was, prev_cp != 32, prev != kind)
    first |= space & (~was | follows)
    # contractions
    q = np.flatnonzero((cp == 39) & first)
    if len(q):
        same1 = ~begin[np.minimum(q + 1, n)]
        same2 = same1 & ~begin[np.minimum(q + 2, n)]
        padded = np.r_[cp, [0, 0, 0]]
        c1, c2 = padded[q + 1], padded[q + 2]
        one = same1 & np.isin(c1, [ord(c) for c in "stmd"])
        two = same2 & (((c2 == ord("e")) & ((c1 == ord("r")) | (c1 == ord("v")))) | ((c1 == ord("l")) & (c2 == ord("l"))))
        for hit, size in ((one, 1), (two & ~one, 2)):
            h = q[hit]
            first[h + 1] = False
            after = h + 1 + size
            after = after[after < n]
            first[after] = True
    return at[first]


def _merge(ids: np.ndarray, v: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    """BPE of the rows of a matrix padded with -1: (row numbers, matrix of the same rows) as rows come to their end.

    Every round, each row merges its leftmost pair of the least rank, and with it the other places of the same pair that don't
    overlap: a merge makes only pairs of higher rank, so these would be next, from left to right. Then rows are compacted to the
    left and columns that no row needs go.
    """
    done, rows = [], np.arange(len(ids))
    rank = np.full(ids.shape, _NONE, np.int32)
    rank[:, :-1] = v.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
    while len(rows):
        least = rank.min(axis=1)
        end = least == _NONE
        if end.any():
            done.append((rows[end], ids[end]))
            go = ~end
            rows, ids, rank, least = rows[go], ids[go], rank[go], least[go]
            if not len(rows):
                break
        hit = rank == least[:, None]
        if (hit[:, 1:] & hit[:, :-1]).any():  # equal ids in a row: every second place
            col = np.arange(hit.shape[1])
            gap = np.maximum.accumulate(np.where(hit, -1, col), axis=1)
            hit &= ((col - gap) % 2) == 1
        r, c = np.nonzero(hit)
        ids[r, c] = v.merged[least[r]]
        keep = ids >= 0
        keep[r, c + 1] = False
        place = np.cumsum(keep, axis=1) - 1
        width = int(place[:, -1].max()) + 1
        kr, kc = np.nonzero(keep)
        to = place[kr, kc]
        new_ids = np.full((len(rows), width), -1, np.int32)
        new_rank = np.full((len(rows), width), _NONE, np.int32)
        new_ids[kr, to], new_rank[kr, to] = ids[kr, kc], rank[kr, kc]
        p = place[r, c]
        wide = p + 1 < width
        new_rank[r, p] = _NONE
        new_rank[r[wide], p[wide]] = v.rank(new_ids[r[wide], p[wide]], new_ids[r[wide], p[wide] + 1])
        left = p > 0
        new_rank[r[left], p[left] - 1] = v.rank(new_ids[r[left], p[left] - 1], new_ids[r[left], p[left]])
        ids, rank = new_ids, new_rank
    return done


def _merge_long(ids: np.ndarray, size: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """BPE of rows that follow one another in ``ids``: (ids left, how many of each row). For rows so long that rounds over all of their places would cost too much.

    Ranks are taken in ascending order, for all rows at once; a round looks only at the places whose pair has that rank, from left to right without
    overlap. That is the order of _merge, as a merge makes only pairs of higher rank. Places are linked to their neighbours instead of compacted.
    """
    n = len(ids)
    ids, row = ids.copy(), np.repeat(np.arange(len(size)), size)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(size)
    after[ends - 1] = before[ends - size] = -1
    rank = np.full(n, _NONE, np.int32)
    waiting: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def put(places: np.ndarray) -> None:
        """Look up the pairs that begin at these places and let them wait for their ranks."""
        to = after[places]
        rank[places] = np.where(to >= 0, v.rank(ids[places], ids[np.maximum(to, 0)]), _NONE)
        places = places[rank[places] != _NONE]
        places = places[np.argsort(rank[places], kind="stable")]
        for part in np.split(places, np.flatnonzero(np.diff(rank[places])) + 1):
            if len(part):
                r = int(rank[part[0]])
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(part)

    put(np.arange(n))
    while queue:
        r = heapq.heappop(queue)
        at = np.unique(np.concatenate(waiting.pop(r)))
        at = at[(rank[at] == r) & (ids[at] >= 0)]
        if not len(at):
            continue
        # in a run of places that overlap every second one merges
        chained = np.r_[False, after[at[:-1]] == at[1:]]
        begin = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
        at = at[(np.arange(len(at)) - begin) % 2 == 0]
        gone = after[at]
        ids[at], ids[gone], rank[gone] = v.merged[r], -1, _NONE
        after[at] = after[gone]
        there = after[at] >= 0
        before[after[at][there]] = at[there]
        left = before[at]
        put(np.unique(np.r_[at, left[left >= 0]]))
    left = ids >= 0
    return ids[left], np.bincount(row[left], minlength=len(size))


def _flat(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the spans, one after the other."""
    end = np.cumsum(size)
    return np.arange(int(end[-1]) if len(end) else 0) + np.repeat(start - (end - size), size)


def _distinct(b: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of a representative for each distinct piece, and for each piece which of them it is.

    By 64-bit polynomial hashes over the buffer; bytes are then compared, so equal hashes of unequal pieces do no harm.
    """
    with np.errstate(over="ignore"):
        mixed = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(b), _P)])
        inverse = np.uint64(pow(int(_P), -1, 2**64))
        back = np.cumprod(np.r_[np.uint64(1), np.full(len(b), inverse)])
        total = np.r_[np.uint64(0), np.cumsum(mixed * power[:-1])]
        h = (total[start + size] - total[start]) * back[start] + size.astype(np.uint64)
    _, rep, of = np.unique(h, return_index=True, return_inverse=True)
    like = rep[of]
    ok = size == size[like]
    same = b[_flat(start, size)] == b[_flat(np.where(ok, start[like], start), size)]
    if ok.all() and same.all():
        return rep, of
    words, of = np.unique(np.array([b[s : s + n].tobytes() for s, n in zip(start, size, strict=True)], object), return_inverse=True)
    rep = np.zeros(len(words), np.int64)
    rep[of] = np.arange(len(of))
    return rep, of


def _encode(b: np.ndarray, offsets: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of the distinct pieces one after the other, their offsets, the distinct piece of each piece, pieces before each text)."""
    start = _pieces(b, offsets)
    size = np.diff(np.r_[start, len(b)])
    rep, of = _distinct(b, start, size) if len(start) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    first, length = start[rep], size[rep]
    count, parts = np.zeros(len(rep), np.int64), []
    bucket = np.ceil(np.log2(np.maximum(length, 2))).astype(int)
    long = np.flatnonzero(length > LONG_BYTES)
    if len(long):
        flat, count[long] = _merge_long(v.byte_ids[b[_flat(first[long], length[long])]], length[long], v)
        parts.append((long, flat))
        bucket[long] = -1
    for k in np.unique(bucket[bucket >= 0]):
        mine = np.flatnonzero(bucket == k)
        most = max(1, 2_000_000 >> int(k))
        for i in range(0, len(mine), most):
            rows = mine[i : i + most]
            ids = np.full((len(rows), int(length[rows].max()) + 1), -1, np.int32)
            r = np.repeat(np.arange(len(rows)), length[rows])
            ids[r, _flat(np.zeros(len(rows), np.int64), length[rows])] = v.byte_ids[b[_flat(first[rows], length[rows])]]
            for which, matrix in _merge(ids, v):
                there = matrix >= 0
                count[rows[which]] = there.sum(axis=1)
                parts.append((rows[which], matrix[there]))
    word_offsets = np.r_[0, np.cumsum(count)]
    ids = np.zeros(int(word_offsets[-1]), np.int32)
    for which, flat in parts:
        ids[_flat(word_offsets[which], count[which])] = flat
    return ids, word_offsets, of, np.searchsorted(start, offsets)


def _passes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of consecutive texts of about PASS_BYTES together; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    all_offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(all_offsets, all_offsets[i] + PASS_BYTES, side="right")) - 1)
        o = all_offsets[i : j + 1]
        yield i, j, data[o[0] : o[-1]], o - o[0]
        i = j


def encode_texts(texts: pa.Array, path: str = VOCABULARY) -> pa.Array:
    """The ids of each text as a list; empty for an empty or null text."""
    v, parts = vocabulary(path), []
    for i, j, b, offsets in _passes(texts):
        ids, word_offsets, of, before = _encode(b, offsets, v)
        size = np.diff(word_offsets)[of]
        total = np.r_[0, np.cumsum(size)]
        flat = ids[_flat(word_offsets[:-1][of], size)]
        parts.append(pa.ListArray.from_arrays(pa.array(total[before].astype(np.int32)), pa.array(flat)))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def count_texts(texts: pa.Array, path: str = VOCABULARY) -> pa.Array:
    """The number of ids of each text; 0 for an empty or null text."""
    v, parts = vocabulary(path), []
    for i, j, b, offsets in _passes(texts):
        _, word_offsets, of, before = _encode(b, offsets, v)
        total = np.r_[0, np.cumsum(np.diff(word_offsets)[of])]
        parts.append(np.diff(total[before]))
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())


def _over(df: DataFrame, keep: list[str], text: str, name: str, kind: str, fn, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], fn(b.column(b.num_columns - 1), path)], [*keep, name])

    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(*keep).dtypes)
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, f"{fields}, {name} {kind}")


def encode(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``ids array<int>``: the ids of each text by the vocabulary at ``path``, without special tokens.

    Null and empty texts have an empty list. Texts are encoded whole, however long; their batches are passed through the
    masks in parts. Strings that look like special tokens are ordinary text. Repeated rows are encoded alike; other columns are not
    read. No shuffle. ``path`` must be readable by every executor.
    """
    return _over(df, keep, text, "ids", "array<int>", encode_texts, path)


def token_counts(df: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens bigint``, as encode would give them."""
    return _over(df, keep, text, "n_tokens", "bigint", count_texts, path)
