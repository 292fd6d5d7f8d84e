"""Benchmark decontamination: an FM-index of each training shard is searched backwards for the benchmark's windows.

A shard is a run of whole documents, cut at ``SHARD_WORDS`` words. Words that no benchmark item has cannot be part of an occurrence,
so each run of them is one terminator of the index; every other word is a symbol. No row is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED
from .fm_index import FMIndex

WINDOW = 10
#: A shard is closed at this many words (about 7 MB of text); a longer document is a shard of its own.
SHARD_WORDS = 1_000_000
#: Benchmark items are searched in blocks of about this many bytes, each one pass; a block is what a task holds.
BLOCK_BYTES = 8_000_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(SPACED).split() if text else []


class Phrases:
    """Distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(item)
        self.owners = [sorted(x, key=str) for x in owners.values()]
        self.lengths = np.array([len(k) for k in owners], np.int64)
        self.matrix = np.zeros((len(owners), window), np.int64)
        for i, k in enumerate(owners):
            self.matrix[i, window - len(k) :] = k


def search_shard(words: list[np.ndarray], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """words: each document's symbols (0: a word of no item). Occurrences: document, word position, phrase."""
    none = np.zeros(0, np.int64)
    if not words or not len(phrases.lengths):
        return none, none, none
    # A document's end is a terminator too.
    all_words = np.concatenate([np.append(w, 0) for w in words])
    row = np.repeat(np.arange(len(words)), [len(w) + 1 for w in words])
    keep = all_words != 0
    keep[1:] |= all_words[:-1] != 0
    keep[-1] = True
    where = np.flatnonzero(keep)
    index = FMIndex(all_words[where], len(phrases.vocabulary))
    lo, hi = index.search(phrases.matrix, phrases.lengths)
    found = np.flatnonzero(hi > lo)
    many = (hi - lo)[found]
    if not many.sum():
        return none, none, none
    phrase = np.repeat(found, many)
    rows = np.repeat(lo[found], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    place = where[index.locate(rows)]
    begin = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
    return row[place], place - begin[row[place]], phrase


def merged(begin: np.ndarray, end: np.ndarray) -> list[list[int]]:
    out: list[list[int]] = []
    for b, e in sorted(zip(begin.tolist(), end.tolist(), strict=True)):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return out


def _pass(docs: DataFrame, phrases: Phrases, text_col: str, others: list[str]) -> DataFrame:
    """One pass of one block: adds to _n_words, _spans (flat begins and ends of removal spans) and _items of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    schema = docs.select(*others, F.col(text_col)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        get = known.vocabulary.get
        for batch in batches:
            texts = batch.column(text_col)
            first, symbols, held = 0, [], 0
            for i in range(batch.num_rows):
                ws = words_of(texts[i].as_py())
                symbols.append(np.fromiter((get(w, 0) for w in ws), np.int64, len(ws)))
                held += len(ws)
                if held >= SHARD_WORDS or i == batch.num_rows - 1:
                    yield close(batch.slice(first, i + 1 - first), symbols, known)
                    first, symbols, held = i + 1, [], 0

    def close(batch: pa.RecordBatch, symbols: list[np.ndarray], known: Phrases) -> pa.RecordBatch:
        doc, at, phrase = search_shard(symbols, known)
        order = np.argsort(doc, kind="stable")
        doc, at, phrase = doc[order], at[order], phrase[order]
        borders = np.searchsorted(doc, np.arange(len(symbols) + 1))
        spans, items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
        for i in np.unique(doc).tolist():
            mine = slice(borders[i], borders[i + 1])
            old = spans[i]
            begin = np.r_[np.array(old[::2], np.int64), at[mine]]
            end = np.r_[np.array(old[1::2], np.int64), at[mine] + known.lengths[phrase[mine]]]
            spans[i] = [x for pair in merged(begin, end) for x in pair]
            items[i] = sorted({*items[i], *(str(x) for p in np.unique(phrase[mine]).tolist() for x in known.owners[p])})
        out = {name: batch.column(name) for name in batch.schema.names}
        out["_n_words"] = pa.array([len(s) for s in symbols], pa.int64())
        out["_spans"], out["_items"] = pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([out[n] for n in batch.schema.names], names=batch.schema.names)

    return docs.select(*others, F.col(text_col)).mapInArrow(run, schema)


def find_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Every row of docs (doc_id and text, or the columns named in keep) with _n_words, _spans and _items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A window is ``WINDOW`` consecutive words of an
    item, or all of a shorter item. _spans: merged word ranges of all occurrences; _items: items with occurring windows, as
    strings in order. Null texts, empty texts and texts without words have none; items without an id or words match nothing.
    Rows that repeat an id are told apart. The benchmark may be of any size: it is searched in blocks, a pass each.
    """
    items = benchmark.filter(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_col).alias("i"), F.col(item_text).alias("x"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("x")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    own = ["doc_id"] if keep is None else [f"_c{i}" for i in range(len(keep))]
    carried = [F.col(id_col).alias("doc_id")] if keep is None else [F.col(f"`{c}`").alias(n) for n, c in zip(own, keep, strict=True)]
    out = docs.select(
        *carried,
        F.lit(0).cast("long").alias("_n_words"),
        F.array().cast("array<int>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
        F.col(text_col).alias("_text"),
    )
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("i", "x"), F.lit(blocks)) == k).collect()
        out = _pass(out, Phrases([(r.i, r.x) for r in block]), "_text", [*own, "_n_words", "_spans", "_items"])
    if keep is None:
        return out.withColumnRenamed("_text", "text")
    return out.select(*[F.col(n).alias(c) for n, c in zip(own, keep, strict=True)], "_n_words", "_spans", "_items")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated from find_spans."""
    spans = F.col("_spans")
    width = F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        width.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        (width > 0).alias("contaminated"),
    )


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
