"""Helpers that the operators of this subpackage share: words, rolling hashes, scratch space."""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHUNK = 1 << 20
_powers: list[np.ndarray] = []


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset a new one on this machine, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def cut_counted(df: DataFrame, **values: Column) -> tuple[DataFrame, dict]:
    """cut(df), and aggregates over its rows that are taken while these are written, without a further pass."""
    seen = Observation()
    return cut(df.observe(seen, *(v.alias(k) for k, v in values.items()))), seen.get


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset at which each text begins (one more at the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        n = max(n, _CHUNK)
        _powers[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, b, np.uint64))), dtype=np.uint64) for b in (_BASE, _BASE_INVERSE)]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _words_of(data: np.ndarray, at: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if lower:
        data = LOWER[data]
    space = SPACE[data]
    before = np.empty(n, bool)
    before[1:], before[0] = space[:-1], True
    after = np.empty(n, bool)
    after[:-1], after[-1] = space[1:], True
    inner = at[(at > 0) & (at < n)]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    power, inverse = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts]), starts, ends


def words(data: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every word of the texts: a 64-bit hash, first byte, byte after the last, number of its text.

    Works in pieces of about a megabyte that are cut at white space, so memory follows the words."""
    found, n, begin = [], len(data), 0
    while begin < n:
        end = min(n, begin + _CHUNK)
        if end < n:
            back = np.flatnonzero(SPACE[data[begin:end]])
            if len(back):
                end = begin + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(SPACE[data[end:]])
                end = end + int(ahead[0]) + 1 if len(ahead) else n
        h, s, e = _words_of(data[begin:end], at - begin, lower)
        found.append((h, s + begin, e + begin))
        begin = end
    h, s, e = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    return h, s, e, np.searchsorted(at, s, "right") - 1


def rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Hash of every k consecutive values (by doubling); empty if there are fewer."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out, size, have = None, 1, 0
    level = h
    with np.errstate(over="ignore"):
        while True:
            if k & size:
                out = level[: len(h) - k + 1].copy() if out is None else out * np.uint64(pow(base, size, 1 << 64)) + level[have : have + len(h) - k + 1]
                have += size
            if size * 2 > k:
                return mix(out)
            level = level[:-size] * np.uint64(pow(base, size, 1 << 64)) + level[size:]
            size *= 2


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every `width` consecutive values."""
    size = 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def _give_back() -> None:
    """Hands memory that freed arrays took back to the system, where the C library can; workers live on, and would keep their peak."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def pieces(batch: pa.RecordBatch, text: str, most: int = 4 << 20):
    """Slices of a batch with about `most` bytes of text at most, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(n)
    if begin < len(sizes):
        yield batch.slice(begin)
    _give_back()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
