"""Helpers shared by the operators: table access, written intermediates, byte-level words.

Words are the maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` after A-Z are
lower-cased, exactly the contract's ``[^\\x20\\x09-\\x0D]+``.  They are found and
hashed for a whole Arrow batch at once (numpy over the batch's own text
buffer), so the per-word cost is a few nanoseconds and no Python object is
made for a word.  A text is never cut: a batch is only split between rows.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.session import checkpoint_dir
from cinerank.sources.tables import table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["table", "scratch_path", "written", "small_enough", "maybe_broadcast", "held_out", "Words", "text_slices", "mix64", "shingles", "column"]

#: Broadcast bound: a side is broadcast only when its counted rows times the
#: stated row width stay under this many bytes; otherwise the plan shuffles.
BROADCAST_BYTES = 32 << 20
#: Text bytes handled at once inside a task (a single longer text still goes whole).
SLICE_BYTES = 1 << 19
#: Rows handled at once inside a task, however short their texts are.
SLICE_ROWS = 1024
#: Bytes of an Arrow batch that a Python worker is sent at once while a table is written (a longer row goes whole).
BATCH_BYTES = 4 << 20
#: The same and ``SLICE_BYTES`` for steps that share an executor with much else: a batch is held several times
#: over outside the heap, and words take some fifty times their slice while they are hashed.
SMALL_BATCH_BYTES, SMALL_SLICE_BYTES = 1 << 20, 1 << 17
#: Off while a table is written: a vectored read copies whole column chunks through buffers outside the heap,
#: which the reading threads keep.
VECTORED_READS = "parquet.hadoop.vectored.io.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    Cuts lineage in a way that survives executor loss, lets later steps prune
    columns, and stores far less than a row-format checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes), VECTORED_READS: "false"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(n_rows: int, row_bytes: int) -> bool:
    return n_rows * row_bytes <= BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, row_bytes: int, n_rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its measured size is under the bound, else as it is."""
    n = df.count() if n_rows is None else n_rows
    return F.broadcast(df) if small_enough(n, row_bytes) else df


def held_out(doc_id: Column) -> Column:
    """The contract's fold: crc32 of the id's text modulo 5 is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


# --- bytes to words ---------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _odd_stream(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE_MUL = _odd_stream(4096, 11)
_WORD_MUL = _odd_stream(64, 23)


class Words:
    """Words of a run of texts: 64-bit hashes, and the first word of each text."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        x = _LOWER[buf]
        inside = ~_SPACE[x]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = offs[:-1][offs[:-1] < len(buf)]
        first[at] = inside[at]  # a word never runs on into the next text
        #: byte position of each word's first byte
        self.starts = np.flatnonzero(first)
        self.offs = np.searchsorted(self.starts, offs)  # word range of each text
        idx = np.flatnonzero(inside)
        if len(idx) == 0:
            self.hash = np.zeros(0, dtype=np.uint64)
            self.ends = self.starts
            return
        heads = np.flatnonzero(first[idx])
        length = np.diff(np.append(heads, len(idx)))
        pos = np.arange(len(idx)) - np.repeat(heads, length)
        mul = _BYTE_MUL[pos & 4095]
        if pos[-1] > 4095 or length.max() > 4096:
            mul = mul * ((pos >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        h = np.add.reduceat((x[idx].astype(np.uint64) + np.uint64(1)) * mul, heads)
        self.hash = mix64(h + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.ends = self.starts + length  # a word's bytes are contiguous


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the n-word shingles of each text in order, repeats kept.

    A text with 1 to n-1 words has one shingle, its whole word sequence (tagged
    with its length, so it never equals an n-word shingle); without words, none.
    """
    h, offs = words.hash, words.offs
    count = np.diff(offs)
    full = np.maximum(count - n + 1, 0)
    out = np.where((count > 0) & (count < n), 1, full)
    so = np.concatenate([[0], np.cumsum(out)])
    res = np.zeros(so[-1], dtype=np.uint64)
    if len(h) >= n:
        s = h[: len(h) - n + 1] * _WORD_MUL[0]
        for k in range(1, n):
            s = s + h[k : len(h) - n + 1 + k] * _WORD_MUL[k]
        ok = np.repeat(offs[:-1], full) + (np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full))
        to = np.repeat(so[:-1], full) + (np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full))
        res[to] = mix64(s[ok])
    for d in np.flatnonzero((count > 0) & (count < n)):
        w = h[offs[d] : offs[d + 1]]
        tag = np.array([len(w)], dtype=np.uint64) * _WORD_MUL[63]
        res[so[d]] = mix64((w * _WORD_MUL[: len(w)]).sum(keepdims=True) + tag)[0]
    return res, so


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) runs of at most ``rows`` whole rows with at most ``most`` bytes of text (or one row); null is empty."""
    for rb in batches:
        if rb.num_rows == 0:
            continue
        col = rb.column(rb.schema.get_field_index(text))
        if col.null_count:
            col = pc.fill_null(col, "")
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        width = np.int64 if pa.types.is_large_string(col.type) else np.int32
        bufs = col.buffers()
        offs = np.frombuffer(bufs[1], dtype=width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, dtype=np.uint8)
        i = 0
        while i < len(col):
            j = max(i + 1, min(i + rows, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1))
            yield rb.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
            i = j


def column(x: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Numbers or booleans as an Arrow column, null where not ``valid``.

    ``pa.array`` looks for pandas objects and so imports pandas, 24 MB in every Python worker.
    """
    bits = lambda b: pa.py_buffer(np.packbits(b, bitorder="little"))
    data = bits(x) if x.dtype == bool else pa.py_buffer(np.ascontiguousarray(x))
    return pa.Array.from_buffers(pa.from_numpy_dtype(x.dtype), len(x), [None if valid is None else bits(valid), data])


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
