"""Chat formatting: a prefix tree of conversations, written depth-first with position ids and ancestor attention intervals.

Conversations are range-partitioned and sorted by their path of turn hashes (then by id, so that many equal conversations spread over
partitions). Along this order a depth-first walk of the tree is a stream: a conversation adds the turns that its predecessor
doesn't share. Output rows are packs: a run of the walk of at most about ``PACK_CHARS`` code points. In a pack every turn that
conversations share is written once, each segment (turn) has its first position id and the intervals of the pack it attends to.

Tokens are code points here: the code point at offset o of a segment has position ``first position + o``, and attends to its segment up
to itself and to the ancestors' intervals.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
PACK_CHARS = 1_000_000

_INTERVALS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
PACK = "text string, seg_begin array<int>, seg_end array<int>, seg_position array<int>, seg_parent array<int>, loss_begin array<int>, loss_end array<int>, attends array<array<struct<begin:int,end:int>>>, conv_id {kind}, conv_leaf array<int>"


def escape(text: str) -> str:
    """``<``, any backslashes and ``|`` get one more backslash, so no ``<|`` is left; undone by unescape."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where the text under the loss mask lies in it (empty for all but assistants)."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    loss = len(body) if role == ASSISTANT else 0
    return f"{head}{body}{END}\n", len(head), len(head) + loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation. Texts hold no ``<|``, so each marker found is a marker."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest[: rest.rindex(END)])))
    return turns


class Pack:
    def __init__(self) -> None:
        self.chars = 0
        self.parts: list[str] = []
        self.segments: list[tuple[int, int, int, int, int, int]] = []  # begin, end, position, parent, loss begin, loss end
        self.attends: list[list[tuple[int, int]]] = []
        self.convs: list[object] = []
        self.leaves: list[int] = []
        self.stack: list[tuple[tuple[str, str], int]] = []  # the path of the conversation before: turn, segment

    def add(self, conv: object, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.stack)) and self.stack[shared][0] == turns[shared]:
            shared += 1
        del self.stack[shared:]
        for turn in turns[shared:]:
            parent = self.stack[-1][1] if self.stack else -1
            text, loss_begin, loss_end = format_turn(*turn)
            begin, end = self.chars, self.chars + len(text)
            seen, position = [], 0
            if parent >= 0:
                b, e, p = self.segments[parent][:3]
                position = p + e - b
                seen = list(self.attends[parent])
                if seen and seen[-1][1] == b:
                    seen[-1] = (seen[-1][0], e)
                else:
                    seen.append((b, e))
            self.stack.append((turn, len(self.segments)))
            self.segments.append((begin, end, position, parent, begin + loss_begin, begin + loss_end))
            self.attends.append(seen)
            self.parts.append(text)
            self.chars = end
        self.convs.append(conv)
        self.leaves.append(self.stack[-1][1] if self.stack else -1)

    def batch(self, ids: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.segments, strict=True)) or [()] * 6
        ints = [pa.array([list(c)], pa.list_(pa.int32())) for c in columns]
        attends = pa.array([[[{"begin": b, "end": e} for b, e in s] for s in self.attends]], pa.list_(_INTERVALS))
        names = ["text", "seg_begin", "seg_end", "seg_position", "seg_parent", "loss_begin", "loss_end", "attends", "conv_id", "conv_leaf"]
        return pa.RecordBatch.from_arrays([pa.array(["".join(self.parts)]), *ints, attends, pa.array([self.convs], pa.list_(ids)), pa.array([self.leaves], pa.list_(pa.int32()))], names=names)


def pack_conversations(rows: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """Packs of all conversations in rows (conv_id, turn, role, text).

    Turns are in order of turn, then role, then text (nulls first), so repeated rows stay, in a fixed order. A null role or text is
    empty. Rows with a null conv_id are one conversation. A conversation longer than a pack is a pack of its own.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.select("conv_id", turn.alias("one")).groupBy("conv_id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    # The path: a hash of each turn, as binary, so that shared beginnings are shared prefixes.
    path = F.array_join(F.transform("turns", lambda t: F.lpad(F.hex(F.xxhash64(t["role"], t["text"])), 16, "0")), "")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = convs.withColumn("path", path).repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    kind = rows.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = Pack()
        for batch in batches:
            ids = batch.column("conv_id")
            turns = batch.column("turns")
            for i in range(batch.num_rows):
                if pack.chars >= pack_chars:
                    yield pack.batch(ids.type)
                    pack = Pack()
                pack.add(ids[i].as_py(), [(t["role"], t["text"]) for t in turns[i].as_py()])
        if pack.convs:
            yield pack.batch(ids.type)

    return ranged.select("conv_id", "turns").mapInArrow(run, PACK.format(kind=T.ArrayType(kind).simpleString()))


def read_back(packs: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation, from packs alone."""
    kind = packs.schema["conv_id"].dataType.elementType
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                p = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                out: list[tuple] = []
                for conv, leaf in zip(p["conv_id"], p["conv_leaf"], strict=True):
                    spans = [*((x["begin"], x["end"]) for x in p["attends"][leaf]), (p["seg_begin"][leaf], p["seg_end"][leaf])]
                    formatted = "".join(p["text"][b:e] for b, e in spans)
                    turns = parse(formatted)
                    loss, at = [], leaf
                    while at >= 0:
                        if p["loss_end"][at] > p["loss_begin"][at]:
                            loss.append(p["text"][p["loss_begin"][at] : p["loss_end"][at]])
                        at = p["seg_parent"][at]
                    said = [unescape(x) for x in reversed(loss)]
                    both = "".join(f"{role}\n{text}\n" for role, text in turns)
                    out.append((conv, len(turns), _sha(both), sum(map(len, said)), _sha("".join(said)), len(formatted)))
                columns = list(zip(*out, strict=True))
                types = [batch.column("conv_id").type.value_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return packs.mapInArrow(run, f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
