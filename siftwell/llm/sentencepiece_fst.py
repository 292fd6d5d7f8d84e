"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled machines: the normaliser (dummy prefix, white space, space to U+2581), the pieces (a trie by its labels), the byte fallback
(a character that is no piece to its UTF-8 bytes), and a context machine that weighs a piece after the one before it. An input is
composed with them lazily, and the path of least weight in the tropical semiring (min, +) is its encoding.

Weights: of a unigram model, minus the piece's score, for all contexts. Of a BPE model, 0 if merging the two pieces' joined text
gives just these two, else infinite: a sequence is the canonical BPE encoding exactly if each adjacent pair is, so one path has a
finite weight. As each prefix of it is canonical too, one state for each position is enough.

A batch is encoded at once: Arrow cuts its tapes into parts that no piece spans and numbers the distinct ones, these are composed and
searched together (``lattice``), each once, and numpy deals the paths' labels out to the rows. Decoding gathers the labels' bytes the
same way. Parts of more than ``SHORT`` bytes are searched one by one.
"""

from __future__ import annotations

import codecs
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_buffers
from .lattice import ByteTrie, Table, relax

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Kinds of pieces and models in the model file's format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Entries of a task's cache of pairs of pieces; a full cache is emptied.
PAIRS = 1_000_000
#: Bytes of a part that is searched together with others.
SHORT = 255
#: A part: the spaces before a word and the word. No piece spans two parts (checked when the model is compiled).
PART = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Bytes of text that are encoded at once.
CHUNK = 2_000_000
#: Bytes of distinct parts that are searched at once: a byte has some five arcs, of about 80 bytes each while they are sorted.
SEARCHED = 150_000
#: Bytes of the character that a byte begins.
CHAR_BYTES = np.array([1 if b < 0xC0 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4 for b in range(256)])
codecs.register_error("each_byte", lambda e: ("\ufffd", e.start + 1))
#: The context machine's state before the first piece, and the label of a byte fallback.
START, FALLBACK = -2, -1


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        else:
            size = number() if wire == 2 else {5: 4, 1: 8}[wire]
            yield key >> 3, data[i : i + size]
            i += size


@dataclass(frozen=True)
class Normaliser:
    """A deterministic transducer on characters. States: START, TEXT and, where white space is squeezed, GAP (spaces are held back)."""

    dummy_prefix: bool = True
    squeeze: bool = False
    escape: bool = True

    def run(self, text: str) -> str:
        """The output tape, arc by arc: the definition that ``tapes`` is held to."""
        space = SPACE if self.escape else " "
        out, state = [], "START"
        for char in text:
            if char == " " and self.squeeze:
                state = state if state == "START" else "GAP"
                continue
            if state == "START" and self.dummy_prefix:
                out.append(space)
            elif state == "GAP":
                out.append(space)
            out.append(space if char == " " else char)
            state = "TEXT"
        return "".join(out)

    def tapes(self, texts: pa.Array) -> pa.Array:
        """The tapes of a batch, with U+2581 as a space still where it is escaped (both are one symbol there). Nulls are empty."""
        texts = pc.fill_null(texts, "")
        if self.squeeze:
            texts = pc.utf8_trim(pc.replace_substring_regex(texts, " +", " "), " ")
        if self.escape and pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        if self.dummy_prefix:
            none, space = pa.scalar("", texts.type), pa.scalar(" ", texts.type)
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(none, texts, space))
        return texts


@dataclass
class Transducer:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int = BPE
    normaliser: Normaliser = Normaliser()
    by_text: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if USER in self.kinds:
            raise ValueError("pieces that are matched before all others are not compiled")
        rows = list(zip(self.pieces, self.kinds, strict=True))
        self.by_text = {p: i for i, (p, k) in enumerate(rows) if k == NORMAL and p}
        self.bytes_of = np.full(256, -1, np.int32)
        for i, (p, k) in enumerate(rows):
            if k == BYTE:
                self.bytes_of[int(p[1:-1], 16)] = i
        self.unknown = self.kinds.index(UNKNOWN) if UNKNOWN in self.kinds else 0
        self.inner = {pair for text in self.by_text for pair in zip(text, text[1:])}
        self.longest = max(map(len, self.by_text), default=1)
        escape = self.normaliser.escape
        tape = lambda text: (text.replace(SPACE, " ") if escape else text).encode()
        # A single byte that is in no piece is a part of its own.
        self.alone = np.array([b < 128 and b != 32 and not any(chr(b) in text for text in self.by_text) for b in range(256)])
        self.whole_parts = escape and all(PART.match(p).end() == len(p) for p in self.by_text)
        # The weights of a unigram model; the last, for a fallback, is above all others.
        self.weights = -np.array([*self.scores, min(self.scores, default=0.0) - 10.0], np.float32)
        # What each label writes.
        plain = [b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else bytes([int(p[1:-1], 16)]) if k == BYTE else tape(p) for p, k in rows]
        self.written = np.frombuffer(b"".join(plain), np.uint8)
        self.sizes = np.array([len(x) for x in plain], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.trie = ByteTrie([tape(p) for p in self.by_text], list(self.by_text.values()))
        if self.model == BPE:
            self._compile_contexts()
        self._caches()

    def _compile_contexts(self) -> None:
        """The context machine as arrays: of each piece its edges, one after the other, and all merges of two pieces."""
        edges: list[list[tuple[int, float]]] = [[], []]
        first = np.zeros((2, len(self.pieces)), np.int64)
        # A fallback fits every context only if no character of a piece lacks a piece of its own.
        self.closed = all(c in self.by_text for text in self.by_text for c in text)
        self.sound = np.zeros(len(self.pieces) + 1, bool)
        self.in_order = np.zeros(len(self.pieces), bool)
        self.sound[FALLBACK] = True
        for text, i in self.by_text.items():
            found = self._spines(text)
            self.sound[i] = found is not None
            if found is not None and self.closed:
                self.in_order[i] = found[2]
                for side in (0, 1):
                    first[side, i] = len(edges[side])
                    edges[side] += [(self.by_text[t], until) for t, until in found[side]]
        self.edge_at = first
        self.edge_ids = [np.array([e[0] for e in side], np.int64) for side in edges]
        self.edge_until = [np.array([e[1] for e in side]) for side in edges]
        joined = {(self.by_text[t[:k]] << 20 | self.by_text[t[k:]]): i for t, i in self.by_text.items() for k in range(1, len(t)) if t[:k] in self.by_text and t[k:] in self.by_text}
        self.joins = Table(np.fromiter(joined.keys(), np.int64, len(joined)), np.fromiter(joined.values(), np.int64, len(joined)))
        self.ranks = -np.array(self.scores)

    def merges(self, text: str) -> list[tuple]:
        """Merging by score, the leftmost first: trees (text, rank, left, right); a character's rank is -inf."""
        symbols: list[tuple] = [(c, -math.inf, None, None) for c in text]
        while True:
            best, at = math.inf, -1
            for i in range(len(symbols) - 1):
                piece = self.by_text.get(symbols[i][0] + symbols[i + 1][0])
                if piece is not None and -self.scores[piece] < best:
                    best, at = -self.scores[piece], i
            if at < 0:
                return symbols
            a, b = symbols[at : at + 2]
            symbols[at : at + 2] = [(a[0] + b[0], best, a, b)]

    def _spines(self, text: str) -> tuple | None:
        """Of a piece, (left edge, right edge, in order): each edge has from the character upwards what stands there and the rank
        of the merge that ends it; in order: each merge ranks after those below it. None if merging gives other pieces."""
        trees = self.merges(text)
        if len(trees) != 1:
            return None
        edges = []
        for side in (2, 3):
            node, until, edge = trees[0], math.inf, []
            while node is not None:
                edge.append((node[0], until))
                node, until = node[side], node[1]
            edges.append(edge[::-1])
        stack, in_order = [trees[0]], True
        while stack:
            _, rank, *below = stack.pop()
            for child in below:
                if child is not None:
                    in_order &= child[1] < rank
                    stack.append(child)
        return (*edges, in_order)

    def weight(self, before: str, one: tuple | None, piece: str, two: tuple | None) -> float:
        """Of an arc of the context machine (BPE): 0 if no merge crosses the border while both pieces build up, else infinite."""
        if one is None or two is None:
            return math.inf
        if not (one[2] and two[2]):
            return 0.0 if [t[0] for t in self.merges(before + piece)] == [before, piece] else math.inf
        right, left = one[1], two[0]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = right[i], left[j]
            crossing = self.by_text.get(x + y)
            # Of merges of the same rank the leftmost is done first.
            if crossing is not None and (rank := -self.scores[crossing]) < x_ends and rank <= y_ends:
                return math.inf
            if x_ends == y_ends == math.inf:
                return 0.0
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _weigh_pairs(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """``weight`` of many arcs between sound pieces, as 0 or 1 for infinite."""
        out = np.zeros(len(piece), np.int32)
        plain = self.in_order[before] & self.in_order[piece]
        for k in np.flatnonzero(~plain).tolist():
            one, two = self.pieces[before[k]], self.pieces[piece[k]]
            out[k] = self.weight(one, self._spines(one), two, self._spines(two)) > 0
        on = np.flatnonzero(plain)
        i, j = self.edge_at[1, before[on]], self.edge_at[0, piece[on]]
        while len(on):
            x, x_ends, y, y_ends = self.edge_ids[1][i], self.edge_until[1][i], self.edge_ids[0][j], self.edge_until[0][j]
            crossing = self.joins.get(x << 20 | y)
            rank = self.ranks[crossing]
            barred = (crossing >= 0) & (rank < x_ends) & (rank <= y_ends)
            out[on[barred]] = 1
            go = ~barred & ((x_ends < math.inf) | (y_ends < math.inf))
            right = x_ends <= y_ends
            on, i, j = on[go], (i + right)[go], (j + ~right)[go]
        return out

    def _weigh(self, before: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Weights of arcs by the labels before them; a fallback is the label -1."""
        if self.model != BPE:
            return self.weights[label]
        out = np.where(self.sound[label], np.float32(0), np.float32(math.inf))
        both = np.flatnonzero((before >= 0) & (label >= 0) & self.sound[label])
        key = before[both].astype(np.int64) << 20 | label[both]
        known = self.pair_cache.get(key)
        new = np.flatnonzero(known < 0)
        if len(new):
            fresh, at = np.unique(key[new], return_inverse=True)
            made = self._weigh_pairs(fresh >> 20, fresh & 0xFFFFF)
            known[new] = made[at]
            if self.pair_cache.used > PAIRS:
                self._caches()
            absent = self.pair_cache.get(fresh) < 0
            self.pair_cache.put(fresh[absent], made[absent])
        out[both[known == 1]] = math.inf
        return out

    def arcs(self, text: str, at: int) -> list[tuple[int, int]]:
        """(label, end) of the union of pieces and byte fallback from a position, shortest first; a fallback only for a character
        that is no piece."""
        get, out = self.by_text.get, []
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            label = get(text[at:end])
            if label is not None:
                out.append((label, end))
        if not out or out[0][1] > at + 1:
            out.insert(0, (FALLBACK, at + 1))
        return out

    def shortest(self, text: str) -> list[int]:
        """Output labels of the least-weight path through the composition with one tape of any length.

        cost, label and begin hold of each position the least weight of a path to it and that path's last arc; positions are relaxed
        in order. The context machine's state at a position is that last label, so one state for each is enough (BPE: only one has a
        finite weight).
        """
        n, spines = len(text), {}
        cost, label_of, begin = [0.0] + [math.inf] * n, [START] * (n + 1), [0] * (n + 1)

        def edges(part: str) -> tuple | None:
            if part not in spines:
                spines[part] = self._spines(part)
            return spines[part]

        def weigh(at: int, label: int, end: int) -> float:
            if self.model != BPE:
                return float(self.weights[label])
            part = text[at:end]
            if not at:
                return 0.0 if edges(part) else math.inf
            if (text[at - 1], text[at]) not in self.inner:
                return 0.0 if edges(part) else math.inf
            before = text[begin[at] : at]
            key = (before, part)
            if key not in spines:
                spines[key] = self.weight(before, edges(before), part, edges(part))
            return spines[key]

        for at in range(n):
            for label, end in self.arcs(text, at):
                if cost[at] < cost[end]:
                    found = cost[at] + weigh(at, label, end)
                    if found < cost[end]:
                        cost[end], label_of[end], begin[end] = found, label, at
        out: list[int] = []
        end = n
        while end:
            label, at = label_of[end], begin[end]
            out += (label,) if label >= 0 else self._fallback(text[at:end])[::-1]
            end = at
        return out[::-1]

    def _fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.bytes_of[list(char.encode())].tolist()) if (self.bytes_of >= 0).all() else (self.unknown,)

    def part(self, text: str) -> list[int]:
        """The path of one part. No arc spans two characters that no piece has side by side, so it is cut there first."""
        inner, out, begin = self.inner, [], 0
        known: dict[str, list[int]] = {}
        for end in [*(k for k, pair in enumerate(zip(text, text[1:]), 1) if pair not in inner), len(text)]:
            piece = text[begin:end]
            if piece not in known:
                known[piece] = self.shortest(piece)
            out += known[piece]
            begin = end
        return out

    def search(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """borders and labels of the paths of short parts of a tape (a space stands for U+2581)."""
        data, begin, end = text_buffers(parts)
        size = end - begin
        ends = np.cumsum(size + 1) - 1
        heads = ends - size
        room = int(ends[-1]) + 1
        cells = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
        text = np.zeros(room, np.uint8)
        text[cells] = data[int(begin[0]) : int(end[-1])]
        where = np.repeat(np.arange(len(size)), size)
        chars = (data[int(begin[0]) : int(end[-1])] & 0xC0) != 0x80
        at, of = cells[chars], where[chars]
        one, two, label = self.trie.arcs(text, at, ends[of])
        wide = CHAR_BYTES[text[at]]
        single = np.zeros(room, bool)
        single[one[two - one == CHAR_BYTES[text[one]]]] = True
        lone = np.flatnonzero(~single[at])
        one, two, label = np.r_[one, at[lone]], np.r_[two, (at + wide)[lone]], np.r_[label, np.full(len(lone), FALLBACK)]
        head_of = np.zeros(room, np.int64)
        head_of[cells] = heads[where]
        last, back = relax(one, two, label, one - head_of[one], heads, room, self._weigh, START)
        written = np.full(room, -1, np.int32)
        now, stop = ends, heads
        while len(now):
            label, here = last[now], back[now]
            if (label == START).any():
                raise ValueError("a tape without a path")
            written[here] = label
            lone = label == FALLBACK
            if lone.any():
                a, b = here[lone], now[lone]
                if (self.bytes_of >= 0).all():
                    for k in range(4):
                        on = a + k < b
                        written[a[on] + k] = self.bytes_of[text[a[on] + k]]
                else:
                    written[a] = self.unknown
            more = here > stop
            now, stop = here[more], stop[more]
        marked = written >= 0
        upto = np.r_[0, np.cumsum(marked)]
        return np.r_[upto[heads], upto[room]], written[marked]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """borders (n + 1) and labels of the paths of all texts of an Arrow array; nulls and empty texts have none."""
        tapes = self.normaliser.tapes(texts)
        data, begin, end = text_buffers(tapes)
        if not len(tapes) or begin[0] == end[-1]:
            return np.zeros(len(tapes) + 1, np.int64), np.zeros(0, np.int32)
        if not self.whole_parts:
            paths = [self.shortest(t.replace(" ", SPACE) if self.normaliser.escape else t) for t in tapes.to_pylist()]
            return np.r_[0, np.cumsum([len(x) for x in paths])], np.array([i for x in paths for i in x], np.int32)
        lo, hi = int(begin[0]), int(end[-1])
        text = data[lo:hi]
        space, alone = text == 32, self.alone[text]
        cut = np.empty(len(text), bool)
        # A part begins at a run of spaces, at and after a byte of its own, and at each row.
        cut[0] = True
        cut[1:] = space[1:] & ~space[:-1] | alone[1:] | alone[:-1]
        full = begin < end
        cut[begin[full] - lo] = True
        starts = np.flatnonzero(cut)
        places = pa.py_buffer(np.append(starts, len(text)).astype(np.int64))
        parts = pa.LargeStringArray.from_buffers(len(starts), places, pa.py_buffer(np.ascontiguousarray(text))).dictionary_encode()
        distinct = parts.dictionary
        one_by_one = pc.binary_length(distinct).to_numpy() > SHORT
        if self.model == BPE and not self.closed:
            one_by_one[:] = True
        together = distinct.filter(pa.array(~one_by_one))
        borders, flat = np.zeros(1, np.int64), []
        _, first, last = text_buffers(together)
        for a, b in slices(first, last, SEARCHED):
            some, labels = self.search(together.slice(a, b - a))
            borders = np.r_[borders, some[1:] + borders[-1]]
            flat.append(labels)
        flat = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        size = np.zeros(len(distinct), np.int64)
        size[~one_by_one] = np.diff(borders)
        first = np.zeros(len(distinct), np.int64)
        first[~one_by_one] = borders[:-1]
        rest, total = [flat], len(flat)
        for k in np.flatnonzero(one_by_one).tolist():
            path = np.array(self.part(distinct[k].as_py().replace(" ", SPACE)), np.int32)
            first[k], size[k] = total, len(path)
            total += len(path)
            rest.append(path)
        flat = np.concatenate(rest)
        which = parts.indices.to_numpy()
        many = size[which]
        upto = np.cumsum(many)
        ids = flat[np.repeat(first[which] - (upto - many), many) + np.arange(upto[-1])]
        rows = np.searchsorted(starts, np.append(begin, end[-1]) - lo)
        return np.r_[0, upto][rows], ids

    def decode_batch(self, borders: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The outputs of all rows: pieces to text, byte pieces to bytes, without the dummy prefix. A row whose byte pieces are no
        UTF-8 is decoded alone."""
        n = len(borders) - 1
        size, begin = self.sizes[ids], self.begins[ids]
        heads = borders[:-1][borders[:-1] < borders[1:]]
        if self.normaliser.dummy_prefix and len(heads):
            prefixed = heads[(size[heads] > 0) & (self.written[np.minimum(begin[heads], len(self.written) - 1)] == 32)]
            size[prefixed] -= 1
            begin[prefixed] += 1
        upto = np.cumsum(size)
        total = int(upto[-1]) if len(upto) else 0
        text = self.written[np.repeat(begin - (upto - size), size) + np.arange(total)] if total else np.zeros(0, np.uint8)
        at = np.r_[0, upto][borders].astype(np.int64)
        out = pa.LargeStringArray.from_buffers(n, pa.py_buffer(at), pa.py_buffer(text))
        try:
            out.validate(full=True)
        except pa.ArrowInvalid:
            return pa.array([self._decode_one(ids[a:b].tolist()) for a, b in zip(borders[:-1], borders[1:], strict=True)], pa.string())
        return out.cast(pa.string())

    def _decode_one(self, ids: list[int]) -> str:
        """With U+FFFD for each byte that isn't UTF-8 in a run of byte pieces."""
        out: list[bytes] = []
        run = bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.kinds[i] == BYTE:
                run.append(int(self.pieces[i][1:-1], 16))
                continue
            out.append(run.decode("utf-8", "each_byte").encode())
            run.clear()
            if i >= 0:
                out.append(self.written[self.begins[i] : self.begins[i] + self.sizes[i]].tobytes())
        text = b"".join(out).decode()
        return text[1:] if self.normaliser.dummy_prefix and text.startswith(" ") else text

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch(pa.array([text], pa.string()))[1].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_batch(np.array([0, len(ids)]), np.array(ids, np.int64))[0].as_py()

    def _caches(self) -> None:
        none = np.zeros(0, np.int64)
        self.pair_cache = Table(none, none)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "pair_cache"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._caches()


def compile_model(path: str = MODEL) -> Transducer:
    """Reads a SentencePiece model file (its path is on the driver; tasks get the compiled machine)."""
    pieces, scores, kinds, model, rules = [], [], [], UNIGRAM, {}
    for number, value in _fields(open(path, "rb").read()):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0)
            kinds.append(own.get(3, NORMAL))
        elif number == 2:
            model = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            own = dict(_fields(value))
            if own.get(1, b"identity") != b"identity" and own.get(2):
                raise ValueError("only the identity character map is compiled")
            rules = {"dummy_prefix": bool(own.get(3, 1)), "squeeze": bool(own.get(4, 1)), "escape": bool(own.get(5, 1))}
    return Transducer(pieces, scores, kinds, model, Normaliser(**rules))


def encode(docs: DataFrame, model: str = MODEL, text_col: str = "text", others: list[str] | None = None) -> DataFrame:
    """The columns ``others`` (all but the text, unless named) with _ids and _back (the decoded text).

    Null and empty texts have no ids; a null text's _back is null. Ids are those of the model's own library. Every text
    decodes to itself unless it holds U+2581, which decodes to a space, as the format has no other reading of it. Texts of any length
    and script are encoded whole; repeated rows give repeated results, an empty table none. Extra columns are carried through.
    """
    machine = compile_model(model)
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    others = [c for c in docs.columns if c != text_col] if others is None else others
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(others)], F.col(f"`{text_col}`").alias("_t"))
    schema = plain.drop("_t").schema.add("_ids", T.ArrayType(T.IntegerType())).add("_back", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = [f"_c{i}" for i in range(len(others))] + ["_ids", "_back"]
        for batch in batches:
            texts = batch.column("_t")
            _, begin, end = text_buffers(texts)
            for a, b in slices(begin, end, CHUNK):
                part = texts.slice(a, b - a)
                borders, ids = m.encode_batch(part)
                back = m.decode_batch(borders, ids)
                if part.null_count:
                    back = pc.if_else(pc.is_null(part), None, back)
                lists = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(a, b - a) for n in names[:-2]), lists, back], names=names)

    done = plain.mapInArrow(run, schema)
    return done.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(others)], "_ids", "_back")
