"""Line dedup: range-partitioned line hashes with a secondary sort by document, streamed into compressed keep bitmaps.

1. Each document's long lines become rows (hash of the key, document, positions), one for each key of a document, written once.
2. Rows are range-partitioned by (hash, document) and sorted by (hash, document, position). As the document is part of the range,
   the rows of a very common line spread over many partitions; a (hash, document) never spans two.
3. Each partition is streamed: one partial row for each run of a hash (documents, largest document). The few runs that a range
   border cuts are added up by a small aggregation.
4. Occurrences of common hashes outside their keeping document are gathered per document into a bitmap.

Only hashes, ids and positions are shuffled; the text meets its bitmap once, in ``apply_bitmaps``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_TABLE, cut

MIN_CHARS = 40
MIN_DOCS = 5
STRIPPED = b" \t\n\x0b\x0c\r"
ROW_OUT = 20_000
SALTS = 16


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).translate(LOWER_TABLE)


def _long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """h1, h2 (128-bit hash of the key), doc, tkey (hash of the text, tells rows that repeat an id apart), n_lines, at (positions)."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["h1", "h2", "doc", "tkey", "n_lines", "at"]
    types = [pa.int64(), pa.int64(), None, pa.int64(), pa.int32(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tkeys = batch.column("doc"), batch.column("tkey").to_numpy()
            h1, h2, row, n, at = [], [], [], [], []

            def out():
                which = np.array(row, np.int64)
                doc = ids.take(pa.array(which))
                return pa.RecordBatch.from_arrays(
                    [pa.array(h1, types[0]), pa.array(h2, types[1]), doc, pa.array(tkeys[which], types[3]), pa.array(n, types[4]), pa.array(at, types[5])], names=names
                )

            for i, text in enumerate(batch.column("t")):
                raw = text.as_py().encode()
                if len(raw) < min_chars:
                    continue
                lines = raw.split(b"\n")
                found: dict[bytes, list[int]] = {}
                for k, line in enumerate(lines):
                    if len(line) < min_chars:
                        continue
                    key = line_key(line)
                    if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                        found.setdefault(key, []).append(k)
                for key, places in found.items():
                    both = xxhash.xxh3_128_digest(key)
                    h1.append(int.from_bytes(both[:8], "little", signed=True))
                    h2.append(int.from_bytes(both[8:], "little", signed=True))
                    row.append(i)
                    n.append(len(lines))
                    at.append(places)
                if len(row) >= ROW_OUT:
                    yield out()
                    h1, h2, row, n, at = [], [], [], [], []
            if row:
                yield out()

    return (
        docs.filter(F.col(id_col).isNotNull() & (F.length(F.col(text_col)) >= min_chars))
        .select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("tkey"), F.col(text_col).alias("t"))
        .mapInArrow(run, f"h1 long, h2 long, doc {kind}, tkey long, n_lines int, at array<int>")
    )


def _stream_runs(sorted_rows: DataFrame) -> DataFrame:
    """One row for each run of (h1, h2) in a partition: how many documents it has and the largest. State: the open run."""
    kind = sorted_rows.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_run: list | None = None  # h1, h2, documents, largest document
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc"))
            new_key = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
            new_doc = new_key.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            if open_run is not None and (a[0], b[0]) == tuple(open_run[:2]):
                new_doc[0] = doc[0] != open_run[3]
            first = np.flatnonzero(new_key)
            last = np.r_[first[1:], len(a)] - 1
            counts = np.add.reduceat(new_doc.astype(np.int64), first)
            runs = [[a[f], b[f], c, doc[e]] for f, e, c in zip(first, last, counts, strict=True)]
            if open_run is not None:
                if tuple(open_run[:2]) == tuple(runs[0][:2]):
                    runs[0][2] += open_run[2]
                else:
                    runs.insert(0, open_run)
            open_run = runs.pop()
            if runs:
                yield _runs(runs)
        if open_run is not None:
            yield _runs([open_run])

    def _runs(runs: list[list]) -> pa.RecordBatch:
        columns = list(zip(*runs, strict=True))
        return pa.RecordBatch.from_pandas(pd.DataFrame({"h1": columns[0], "h2": columns[1], "docs": columns[2], "last_doc": columns[3]}), preserve_index=False)

    return sorted_rows.mapInArrow(run, f"h1 long, h2 long, docs long, last_doc {kind}")


def keep_bitmap(n_lines: int, dropped: list[int]) -> bytes:
    bits = np.ones(n_lines, np.uint8)
    bits[np.asarray(dropped, np.int64)] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def kept_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc, tkey, dropped_lines and bitmap (compressed, one bit a line, 1: kept) of each document that loses lines.

    A line's key has ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased. Keys of ``min_chars`` code points or more in
    ``min_docs`` documents or more keep their lines in the largest id alone. Null and empty texts are one empty line and lose none.
    Rows with a null id take no part and lose no line. Rows that repeat an id are one document; each row has its own bitmap.
    """
    # Cut, as the rows are used three times: to find the ranges, to count, and to meet the common lines.
    rows = cut(_long_lines(docs, id_col, text_col, min_chars))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "h1", "h2", "doc")
    runs = _stream_runs(ranged.sortWithinPartitions("h1", "h2", "doc", F.element_at("at", 1)).select("h1", "h2", "doc"))
    common = runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc")).filter(F.col("docs") >= min_docs)

    @F.pandas_udf("binary")
    def pack(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
        return pd.Series([keep_bitmap(n, d) for n, d in zip(n_lines, dropped, strict=True)], dtype=object)

    # Salted, so that a line in very many documents is dealt to SALTS tasks.
    salted = common.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = ranged.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int"))
    lost = met.join(salted, ["h1", "h2", "salt"]).filter(F.col("doc") != F.col("last_doc"))
    return (
        lost.groupBy("doc", "tkey")
        .agg(F.max("n_lines").alias("n_lines"), F.flatten(F.collect_set("at")).alias("gone"))
        .select("doc", "tkey", F.size("gone").cast("long").alias("dropped_lines"), pack("n_lines", "gone").alias("bitmap"))
    )


def _apply(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    out = []
    for t, b in zip(text, bitmap, strict=True):
        if b is not None and t is not None:
            lines = t.split("\n")
            t = "\n".join(x for x, on in zip(lines, kept_lines(b, len(lines)), strict=True) if on)
        out.append(t)
    return pd.Series(out, dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", dropped: str | None = "_dropped") -> DataFrame:
    """docs with the dropped lines gone from the text (kept lines joined by \\n) and, unless None, how many as ``dropped``; all other
    columns stay as they are, whatever their names."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    left = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("tkey"), F.col(f"`{text_col}`").alias("t"), row)
    met = left.join(bitmaps.select("doc", "tkey", "dropped_lines", "bitmap"), ["doc", "tkey"], "left")
    apply = F.pandas_udf(_apply, "string")
    hit = F.col("bitmap").isNotNull()
    new = F.when(hit, apply(F.when(hit, F.col("t")), F.col("bitmap"))).otherwise(F.col("t"))
    columns = [new.alias(text_col) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    more = [F.coalesce("dropped_lines", F.lit(0).cast("long")).alias(dropped)] if dropped else []
    return met.select(*columns, *more)
