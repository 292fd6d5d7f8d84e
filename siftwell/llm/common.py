"""What the operators of this subpackage share: shared-folder checkpoints, Arrow text access and 64-bit hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)
#: Base of the rolling hash (odd, so that it has an inverse modulo 2**64).
BASE = 0x2545F4914F6CDD1D
BASE_INV = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where none is named, a local master gets a folder of its own; elsewhere that would
    be out of other machines' reach, so it is an error."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
            import tempfile

            named = tempfile.mkdtemp(prefix="siftwell-checkpoint-")
        context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage through the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def word_tables() -> tuple[bytes, np.ndarray, np.ndarray]:
    """For words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, on UTF-8 bytes: a translation that turns all
    else into spaces, the flag of word bytes, and the lower-cased byte. Every byte of a non-ASCII character is a word byte."""
    raw = np.arange(256)
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    is_word = ((lower >= 48) & (lower <= 57)) | ((lower >= 97) & (lower <= 122)) | (lower >= 128)
    return np.where(is_word, lower, 32).astype(np.uint8).tobytes(), is_word, lower


SPACED, IS_WORD, LOWER = word_tables()
#: Lower-cases A-Z alone.
LOWER_TABLE = LOWER.tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The UTF-8 bytes, the begin and the end of every row's text; nulls are empty."""
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    n = len(column)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    begin, end = offsets[:-1], offsets[1:].copy()
    if column.null_count:
        gone = column.is_null().to_numpy(zero_copy_only=False)
        end[gone] = begin[gone]
    return data, begin, end


def slices(begin: np.ndarray, end: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of at most about ``most`` bytes; a longer row is a range of its own."""
    out, first, size = [], 0, 0
    for i, n in enumerate((end - begin).tolist()):
        if i > first and size + n > most:
            out.append((first, i))
            first, size = i, 0
        size += n
    if first < len(begin):
        out.append((first, len(begin)))
    return out


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", BASE_INV)):
            steps = np.full(max(n, 1 << 16), U64(base))
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of adjacent rows: a 64-bit hash of each lower-cased word, and the row of each word."""
    if not len(begin):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    lo, hi = int(begin[0]), int(end.max())
    part = data[lo:hi]
    if not len(part):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    word = IS_WORD[part]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    first = begin[(begin >= lo) & (begin < hi)] - lo
    before[first] = False
    starts = np.flatnonzero(word & ~before)
    # A word ends where the next byte is no word byte or begins another row.
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    after[first[first > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    up, down = _powers(len(part) + 1)
    sums = np.zeros(len(part) + 1, U64)
    np.cumsum((LOWER[part].astype(U64) + U64(1)) * up[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * GOLDEN)
    rows = np.searchsorted(begin, starts + lo, side="right") - 1
    return hashes, rows


def hashes_of_rows(rows: np.ndarray, values: np.ndarray, place: np.ndarray, n: int, salt: int) -> np.ndarray:
    """An order-dependent 64-bit digest of each row's values; 0 where a row has none."""
    out = np.zeros(n, U64)
    if len(rows):
        scrambled = mix(values + place.astype(U64) * GOLDEN + U64(salt))
        cut_at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[cut_at]] = np.add.reduceat(scrambled, cut_at)
    return out
