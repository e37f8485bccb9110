"""Splitting fields that pack several values into one string.

The scan works on the whole Arrow string buffer of a batch: one array of code
points, quote parity by cumulative counts, delimiter masks by table look-up.
Child offsets follow from the mask positions, the list array is built from
them, and flattening keeps each parent's ordinal. No value is looped over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..runtime import arrow_schema

_WS = np.array([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], dtype=np.uint32)
_SINGLE = np.array([ord(c) for c in ",;|/&\n\r\t"], dtype=np.uint32)
_WORDS = ("and", "with")
_STRAIGHT, _OPEN, _CLOSE = 0x22, 0x201C, 0x201D


def _codes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all values end to end, each value closed by a line end,
    and the offset of each value."""
    col = col.cast(pa.large_string()).fill_null("")
    lengths = pa.compute.utf8_length(col).to_numpy(zero_copy_only=False).astype(np.int64)
    start, end = col.offset, col.offset + len(col)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[start : end + 1]
    data = col.buffers()[2]
    raw = memoryview(data)[offsets[0] : offsets[-1]] if data is not None else b""
    code = np.frombuffer(bytes(raw).decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    return code, np.concatenate([[0], np.cumsum(lengths)])


def _row_of(offsets: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) if n else np.zeros(0, dtype=np.int64)


def split_codes(code: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, position from 1) of every packed value."""
    n, rows = len(code), len(offsets) - 1
    row = _row_of(offsets, n)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    ws = np.isin(code, _WS)
    before_ws = np.concatenate([[True], ws[:-1]]) | first[:n]
    after_ws = np.concatenate([ws[1:], [True]]) | first[1:] if n else ws

    # Quote parity: a straight quote flips, curly quotes nest; both count from the row's start.
    straight = np.cumsum(code == _STRAIGHT)
    curly = np.cumsum((code == _OPEN).astype(np.int64) - (code == _CLOSE))
    base = np.concatenate([[0], straight])[offsets[:-1]]
    cbase = np.concatenate([[0], curly])[offsets[:-1]]
    odd = (np.concatenate([[0], straight])[offsets[1:]] - base) % 2 == 1
    cbad = np.concatenate([[0], curly])[offsets[1:]] != cbase
    inside = (((straight - base[row]) % 2 == 1) & ~odd[row]) | ((curly - cbase[row] > 0) & ~cbad[row])

    cut = np.isin(code, _SINGLE) & ~inside
    width = cut.astype(np.int64)
    for word in _WORDS:
        k = len(word)
        if n < k:
            continue
        hit = np.ones(n - k + 1, dtype=bool)
        for i, ch in enumerate(word):
            hit &= code[i : n - k + 1 + i] == ord(ch)
        hit &= before_ws[: n - k + 1] & after_ws[k - 1 :] & ~inside[: n - k + 1] & (row[: n - k + 1] == row[k - 1 :])
        width[: n - k + 1][hit] = k

    # Segments: between two delimiters, or a delimiter and an end of the row.
    at = np.flatnonzero(width)
    starts = np.concatenate([offsets[:-1], at + width[at]])
    ends = np.concatenate([at, offsets[1:]])
    srow = np.concatenate([np.arange(rows), row[at]])
    erow = np.concatenate([row[at], np.arange(rows)])
    by_s, by_e = np.lexsort((starts, srow)), np.lexsort((ends, erow))
    start, end, seg_row = starts[by_s], ends[by_e], srow[by_s]
    comma_after = np.zeros(len(end), dtype=bool)
    inner = end < offsets[seg_row + 1]
    comma_after[inner] = code[end[inner]] == ord(",")
    last = np.concatenate([seg_row[1:] != seg_row[:-1], [True]]) if len(seg_row) else inner
    comma_after &= ~last

    start, end = _trim(start, end, ws)
    filled = end > start
    token = np.concatenate([[0], np.cumsum(~ws & np.concatenate([[True], ws[:-1]]))]) if n else np.zeros(1, dtype=np.int64)
    gaps = token[end] - token[np.minimum(start + 1, end)]
    quoted = np.zeros(len(start), dtype=bool)
    quoted[filled] = np.isin(code[start[filled]], [_STRAIGHT, _OPEN])
    alone = filled & (gaps == 0) & ~quoted
    nxt = np.concatenate([filled[1:] & ~quoted[1:], [False]]) if len(filled) else filled
    join = alone & comma_after & nxt
    # In a run of joinable segments every second one is a surname.
    idx = np.arange(len(join))
    run_start = np.maximum.accumulate(np.where(join & ~np.concatenate([[False], join[:-1]]), idx, 0)) if len(join) else idx
    join &= (idx - run_start) % 2 == 0
    tail = np.concatenate([[False], join[:-1]]) if len(join) else join
    keep = filled & ~tail
    out_end = np.where(join, np.concatenate([end[1:], end[-1:]]), end)[keep] if len(end) else end
    out_start, out_row = start[keep], seg_row[keep]
    new = np.concatenate([[True], out_row[1:] != out_row[:-1]]) if len(out_row) else np.zeros(0, dtype=bool)
    head = np.maximum.accumulate(np.where(new, np.arange(len(out_row)), 0)) if len(out_row) else out_row
    return out_row, out_start, out_end, np.arange(len(out_row)) - head + 1


def _trim(start: np.ndarray, end: np.ndarray, ws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments without white space at their ends, found by look-up of the next
    and the previous other character."""
    n = len(ws)
    idx = np.arange(n)
    nxt = np.concatenate([np.minimum.accumulate(np.where(ws, n, idx)[::-1])[::-1], [n]]) if n else np.zeros(1, dtype=np.int64)
    prev = np.concatenate([[-1], np.maximum.accumulate(np.where(ws, -1, idx))]) if n else np.full(1, -1)
    s = np.minimum(nxt[start], end)
    return s, np.maximum(prev[end] + 1, s)


def split_lists(col: pa.Array) -> pa.ListArray:
    """The values packed in each string, as a list array (null gives an empty list)."""
    code, offsets = _codes(col)
    row, start, end, _ = split_codes(code, offsets)
    enc = (code[start] if len(start) else np.zeros(0)).astype(np.uint32)
    close = code[np.maximum(end - 1, 0)] if len(end) else enc
    straight = (enc == _STRAIGHT) & (close == _STRAIGHT) & (end - start > 1)
    wrapped = straight | ((enc == _OPEN) & (close == _CLOSE) & (end - start > 1)) | ((enc == _OPEN) & (close == _STRAIGHT) & (end - start > 1))
    s, e = _trim(start + wrapped, end - wrapped, np.isin(code, _WS))
    lengths = e - s
    # Gather all children's code points into one buffer and cut it by their offsets.
    child = np.concatenate([[0], np.cumsum(lengths)])
    take = np.repeat(s - child[:-1], lengths) + np.arange(child[-1])
    picked = code[take].astype(np.uint32) if len(code) else code
    text = picked.tobytes().decode("utf-32-le")
    per_char = np.where(picked < 0x80, 1, np.where(picked < 0x800, 2, np.where(picked < 0x10000, 3, 4))).astype(np.int64)
    byte_at = np.concatenate([[0], np.cumsum(per_char)])
    data = text.encode("utf-8")
    values = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(byte_at[child].astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
    values = pa.compute.if_else(pa.array(straight, type=pa.bool_()), pa.compute.replace_substring(values, '""', '"'), values)
    counts = np.bincount(row, minlength=len(offsets) - 1) if len(row) else np.zeros(len(offsets) - 1, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def explode_packed(df: DataFrame, key: str, field: str, at_least: int = 1, pos_name: str = "name_pos", text_name: str = "name_text") -> DataFrame:
    """One row per packed value of ``field``: key, position from 1, value.

    Empty slots are skipped and don't count. Null and empty fields give no
    rows; a field whose quotes don't pair is split as if they were letters.
    Repeated rows are split each on its own. ``at_least`` drops fields with
    fewer values. No shuffle: a narrow map over the scan.
    """
    kind = df.schema[key]
    from pyspark.sql import types as T

    out = T.StructType([T.StructField(key, kind.dataType), T.StructField(pos_name, T.IntegerType()), T.StructField(text_name, T.StringType())])
    schema = arrow_schema(out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = split_lists(b.column(1))
            counts = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            parent = pa.compute.list_parent_indices(lists).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(counts)])[:-1]
            pos = np.arange(len(parent)) - first[parent] + 1
            keep = counts[parent] >= at_least
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(parent[keep])).cast(schema[0].type), pa.array(pos[keep].astype(np.int32)), lists.flatten().filter(pa.array(keep)).cast(schema[2].type)],
                schema=schema,
            )

    return df.select(key, field).mapInArrow(scan, out)
