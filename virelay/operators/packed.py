"""Several values packed in one text: one row for each value, with its position."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS, BLANKS, QUOTES = b";,/|", b" \t", b"\"'"
BRACKETS = {ord("["): ord("]"), ord("("): ord(")"), ord("{"): ord("}")}

#: States of the quote scan: outside, just closed a quote of kind 0 or 1, inside kind 0 or 1.
_OUT, _SHUT, _IN = 0, 1, 3


def _mask(of: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(of)] = True
    return m


_IS_MARK, _IS_BLANK, _IS_QUOTE = _mask(MARKS), _mask(BLANKS), _mask(QUOTES)


def _inside(b: np.ndarray, first: np.ndarray, row: np.ndarray, opened_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether it is quoted (the quotes themselves count), and which bytes open a quotation.

    Each quote byte is a function on the five states. Functions compose associatively, so their prefix
    compositions come from a doubling scan over the quote bytes, whatever quotes a text mixes.
    ``first`` has the first byte of each byte's text; ``opened_at`` marks bytes where a value may begin.
    """
    q = np.flatnonzero(_IS_QUOTE[b])
    if not len(q):
        return np.zeros(len(b), bool), np.zeros(len(b), bool)
    kind = (b[q] == QUOTES[1]).astype(np.int8)
    beside = np.zeros(len(q), bool)  # directly behind a quote of the same kind in the same text
    beside[1:] = (q[1:] == q[:-1] + 1) & (kind[1:] == kind[:-1]) & (row[q[1:]] == row[q[:-1]])
    step = np.zeros((len(q), 5), np.int8)
    opens = np.where(opened_at[q], _IN + kind, _OUT)
    for s in (_OUT, _SHUT, _SHUT + 1):
        step[:, s] = opens
    for k in (0, 1):
        again = beside & (kind == k)
        step[again, _SHUT + k] = _IN + k  # a doubled quote goes on
        step[:, _IN + k] = np.where(kind == k, _SHUT + k, _IN + k)
    new = np.r_[True, row[q[1:]] != row[q[:-1]]]
    step[new] = step[new][:, [_OUT]]  # each text begins outside
    after, span = step.copy(), 1
    while span < len(q):
        after[span:] = np.take_along_axis(after[span:], after[:-span].astype(np.intp), axis=1)
        span *= 2
    state = after[:, 0]
    before = np.where(new, _OUT, np.r_[_OUT, state[:-1]])
    opening = np.zeros(len(b), bool)
    opening[q[(state >= _IN) & (before < _IN)]] = True
    # the state behind the last quote byte at or before each byte of the same text
    last = np.searchsorted(q, np.arange(len(b)), side="right") - 1
    here = (last >= 0) & (q[np.maximum(last, 0)] >= first)
    quoted = here & (state[np.maximum(last, 0)] >= _IN)
    quoted[q[(before >= _IN) | (state >= _IN)]] = True
    return quoted, opening


def split_packed(texts: pa.Array) -> pa.ListArray:
    """The values of each text as a list, by masks over the string buffer; null gives null.

    Single marks ``; , / |`` separate, or just blanks where no mark is. Blanks and quotes around a value, and one
    pair of brackets around the whole text, don't belong to values; a doubled quote in a quoted value is one quote;
    what is quoted isn't split. A value left out beside a mark is an empty text. An empty or blank text, or empty
    brackets, has no values. A quotation that never closes runs to the end of its text.
    """
    texts = texts.cast(pa.string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    raw = pc.fill_null(texts, "")
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + n + 1].astype(np.int64)
    data = raw.buffers()[2]
    b = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if n else np.zeros(1, np.int64)
    length = np.diff(offsets)
    row = np.repeat(np.arange(n), length)
    first = np.repeat(offsets[:-1], length)
    at = np.arange(len(b))

    blank = _IS_BLANK[b]
    solid = at[~blank]
    lead, trail = np.full(n, -1), np.full(n, -1)
    if len(solid):
        r, i = np.unique(row[solid], return_index=True)
        lead[r], trail[r] = solid[i], solid[np.r_[i[1:], len(solid)] - 1]
    # brackets around the whole
    has = lead < trail
    shut = np.zeros(256, np.uint8)
    for o, c in BRACKETS.items():
        shut[o] = c
    wrapped = np.zeros(n, bool)
    wrapped[has] = (shut[b[lead[has]]] != 0) & (shut[b[lead[has]]] == b[trail[has]])
    opened_at = np.zeros(len(b), bool)
    before = np.r_[np.uint8(0), b[:-1]] if len(b) else b
    opened_at[:] = (at == first) | _IS_BLANK[before] | _IS_MARK[before]
    inner = lead[wrapped] + 1
    opened_at[inner] = True
    quoted, opening = _inside(b, first, row, opened_at)
    wrapped[wrapped] = ~quoted[trail[wrapped]]
    gone = np.zeros(len(b), bool)
    gone[lead[wrapped]] = gone[trail[wrapped]] = True

    mark = _IS_MARK[b] & ~quoted & ~gone
    space = (blank & ~quoted) | gone
    value = ~mark & ~space
    # a run of blanks between two values separates as one mark does
    solid = at[~space]
    follows = np.zeros(len(b), bool)
    if len(solid) > 1:
        a, z = solid[:-1], solid[1:]
        gap = (z > a + 1) & (row[a] == row[z]) & value[a] & value[z]
        follows[a[gap] + 1] = True
    cut = mark | follows
    n_cuts = np.bincount(row[cut], minlength=n)
    filled = np.bincount(row[~space], minlength=n) > 0
    n_items = np.where(filled, n_cuts + 1, 0)
    item_offsets = np.r_[0, np.cumsum(n_items)]
    cuts_before = np.cumsum(cut) - cut
    base = np.r_[0, np.cumsum(n_cuts)][:-1]
    item = item_offsets[:-1][row] + (cuts_before - base[row]) if len(b) else at
    total = int(item_offsets[-1])
    v = at[value]
    start, stop = np.zeros(total, np.int64), np.zeros(total, np.int64)
    if len(v):
        ids, i = np.unique(item[v], return_index=True)
        start[ids], stop[ids] = v[i], v[np.r_[i[1:], len(v)] - 1] + 1
    # quotes around a value
    full = np.flatnonzero(stop - start >= 2)
    s, e = start[full], stop[full] - 1
    q = opening[s] & (b[s] == b[e]) & quoted[e] & ~opening[e]
    full = full[q]
    kind = b[start[full]]
    start[full] += 1
    stop[full] -= 1
    size = stop - start
    out = np.r_[0, np.cumsum(size)]
    take = np.arange(out[-1]) - np.repeat(out[:-1], size) + np.repeat(start, size)
    if out[-1] >= 2**31:
        raise ValueError("a batch of packed texts must stay below 2 GB")
    values = pa.StringArray.from_buffers(total, pa.py_buffer(out.astype(np.int32).tobytes()), pa.py_buffer(b[take].tobytes()))
    for mark_byte in QUOTES:
        two, of = chr(mark_byte) * 2, np.zeros(total, bool)
        of[full[kind == mark_byte]] = True
        if of.any():
            values = pc.if_else(pa.array(of), pc.replace_substring(values, two, two[0]), values)
    valid = texts.is_valid()
    lists = pa.ListArray.from_arrays(pa.array(item_offsets.astype(np.int32)), values)
    return lists if texts.null_count == 0 else pc.if_else(valid, lists, pa.scalar(None, lists.type))


def _slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batch whose texts stay below ``most`` bytes, so that masks fit in memory."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + most, side="right"))
        j = max(j, i + 1)
        yield batch.slice(i, j - i)
        i = j


def explode_packed(df: DataFrame, row_id: str, fields: list[str], least: int = 1, batch_bytes: int = 4_000_000) -> DataFrame:
    """Rows (row_id, field_name, pos, item_text): each value of each field, for texts of at least ``least`` values.

    See split_packed for the rules. ``pos`` starts at 1. Null texts give no rows. Repeated rows each give their
    values. Only ``row_id`` and the fields are read, so other columns, whatever their names, don't matter. No shuffle. With
    ``least`` above 1, texts without any separator are left out before they reach Python; they can't hold two values.
    """
    kind = df.schema[row_id].dataType
    cells = df.select(
        F.col(row_id).alias("__row"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])).alias("c"),
    ).select("__row", "c.field_name", "c.text")
    cells = cells.where(F.col("text").isNotNull())
    if least > 1:
        cells = cells.where(F.col("text").rlike(r"[;,/| \t]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 2, batch_bytes):
                lists = split_packed(batch.column(2))
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                keep = pa.array(np.flatnonzero(counts >= least))
                kept = lists.take(keep)
                parent = pc.list_parent_indices(kept)
                n = counts[counts >= least]
                pos = np.arange(1, len(parent) + 1) - np.repeat(np.cumsum(n) - n, n)
                rows = keep.take(parent)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pos.astype(np.int32)), kept.flatten()],
                    [row_id, "field_name", "pos", "item_text"],
                )

    return cells.mapInArrow(run, f"`{row_id}` {kind.simpleString()}, field_name string, pos int, item_text string")
