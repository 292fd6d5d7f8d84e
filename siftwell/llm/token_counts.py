"""Token counts: greedy longest-match word pieces by a linear automaton, without building any piece.

The vocabulary is a trie with two roots: of pieces that begin a word (with U+2581) and of those that continue one. Each node has a
failure link, the node that is reached by popping the longest pieces from its string, and the number of pieces popped. A word is
then read once, left to right: no letter is read again however pieces overlap.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sentencepiece_fst import BYTE, MODEL, NORMAL, SPACE, USER, compile_model

#: Entries of a task's cache of words; a full cache is emptied.
CACHE = 200_000
UNKNOWN = 0


class Automaton:
    def __init__(self, pieces: Iterable[str], begins: str = SPACE):
        """pieces: those that start with ``begins`` begin a word, others continue it."""
        self.begins = begins
        self.next: list[dict[str, int]] = [{}, {}]  # 0: the root of beginnings, 1: of continuations
        whole: list[bool] = [False, False]
        for piece in sorted(set(pieces)):
            at = 0 if piece.startswith(begins) else 1
            for char in piece:
                to = self.next[at].get(char)
                if to is None:
                    to = self.next[at][char] = len(self.next)
                    self.next.append({})
                    whole.append(False)
                at = to
            if at > 1:
                whole[at] = True
        n = len(self.next)
        self.fail, self.pops = [-1] * n, [0] * n
        queue = deque([0, 1])
        while queue:
            at = queue.popleft()
            for char, to in self.next[at].items():
                if whole[to]:
                    self.fail[to], self.pops[to] = 1, 1
                else:
                    via, popped = self.fail[at], self.pops[at]
                    while via >= 0 and char not in self.next[via]:
                        popped += self.pops[via]
                        via = self.fail[via]
                    if via >= 0:
                        self.fail[to], self.pops[to] = self.next[via][char], popped
                queue.append(to)
        self.cache: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of a word by greedy longest match, or UNKNOWN if some part matches no piece."""
        found = self.cache.get(word)
        if found is not None:
            return found
        follow, fail, pops = self.next, self.fail, self.pops
        at, total = 0, 0
        for char in self.begins + word:
            while True:
                to = follow[at].get(char)
                if to is not None:
                    at = to
                    break
                total += pops[at]
                at = fail[at]
                if at < 0:
                    break
            if at < 0:
                break
        while at > 1:
            total += pops[at]
            at = fail[at]
        total = total if at == 1 else UNKNOWN
        if len(word) <= 48:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = total
        return total

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}


def model_pieces(path: str = MODEL) -> list[str]:
    """The text pieces of a SentencePiece model file, bytes and controls left out."""
    m = compile_model(path)
    return [p for p, k in zip(m.pieces, m.kinds, strict=True) if k in (NORMAL, USER) and k != BYTE]


def token_counts(docs: DataFrame, pieces: Iterable[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown of every row.

    Words are separated by white space. A word that pieces can't cover to its end is one unknown token. Null, empty and blank
    texts have no words. Repeated rows give repeated results; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column("t"):
                counts = [machine.count(w) for w in (text.as_py() or "").split()]
                none = counts.count(UNKNOWN)
                words.append(len(counts))
                tokens.append(sum(counts) + none)
                unknown.append(none)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    ready = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    return ready.mapInArrow(run, T.StructType([ready.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in ("n_words", "n_tokens", "n_unknown"))]))
