"""Word-piece token counts by a linear longest-match automaton.

The vocabulary trie has two roots: one for pieces that begin a word, one for
pieces that continue it.  Each node has a failure link, the node reached after
the longest piece that ends on the way to it has been popped (and, if need be,
further ones), and the number of pieces popped on that way.  A word is read
once, byte by byte: where no edge fits, the automaton follows the failure link
and adds its count, so the greedy longest-match length comes out in linear
time without any piece being built.

The pieces are those of a byte-level vocabulary: a token that starts with a
space begins a word, any other continues one.  Words are maximal runs of bytes
other than space and \\x09-\\x0D.  A word that cannot be cut into pieces is one
unknown token, as in the usual word-piece scheme.

Cases: null and empty texts have no tokens; rows repeating an id are separate
rows; an empty table gives an empty result; other columns pass through.  Words
of over ``KEPT`` bytes are not cached, and a cache beyond ``CACHED`` entries is
emptied.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.byte_bpe import read_ranks
from riskloom.llm.common import table, with_computed

VOCABULARY = "byte_bpe_50k.tiktoken"
KEPT, CACHED, LONG = 64, 400_000, 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def pieces_of(tokens) -> tuple[set[bytes], set[bytes]]:
    """(pieces that begin a word, pieces that continue one) of byte tokens."""
    tokens = [t for t in tokens if not _WORD.sub(b"", t).strip(b" ")]
    return ({t[1:] for t in tokens if t[:1] == b" " and _WORD.fullmatch(t[1:])},
            {t for t in tokens if _WORD.fullmatch(t)})


class Counter(dict):
    """Word -> number of pieces, filled on demand by the automaton."""

    def __init__(self, first: set[bytes], other: set[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]      # node 0 begins a word, node 1 continues it
        ends: list[bool] = [False, False]
        for root, pieces in ((0, first), (1, other)):
            for piece in pieces:
                node = root
                for byte in piece:
                    to = self.edges[node].get(byte)
                    if to is None:
                        to = self.edges[node][byte] = len(ends)
                        self.edges.append({})
                        ends.append(False)
                    node = to
                ends[node] = True
        self.fail: list[int] = [-1] * len(ends)
        self.popped: list[int] = [0] * len(ends)
        level = [0, 1]
        while level:                                      # shorter strings first: links lead to shorter ones
            below = []
            for parent in level:
                for byte, node in self.edges[parent].items():
                    below.append(node)
                    if ends[node]:
                        self.fail[node], self.popped[node] = 1, 1
                        continue
                    at, count = self.fail[parent], self.popped[parent]
                    while at >= 0 and byte not in self.edges[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[node], self.popped[node] = self.edges[at][byte], count
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of one word; 1 (the unknown token) if it can't be cut."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for byte in word:
            to = edges[node].get(byte)
            while to is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                to = edges[node].get(byte)
            node = to
        while node > 1:                                   # what is left must end in pieces
            total += popped[node]
            node = fail[node]
        return total if node == 1 else 1

    def __missing__(self, word: bytes) -> int:
        n = self.count(word)
        if len(word) <= KEPT:
            if len(self) >= CACHED:
                self.clear()
            self[word] = n
        return n

    def text(self, text: bytes) -> tuple[int, int]:
        """(words, tokens) of a text."""
        if len(text) <= LONG:
            words = _WORD.findall(text)
            return len(words), sum(map(self.__getitem__, words))
        words = tokens = 0
        for m in _WORD.finditer(text):
            words += 1
            tokens += self[m.group()]
        return words, tokens


_counters: dict[bytes, Counter] = {}


def _counter(data: bytes) -> Counter:
    key = hashlib.sha256(data).digest()
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(*pieces_of(read_ranks(data)))
    return _counters[key]


def token_counts(df: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``df`` with n_words and n_tokens (long)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())
    column = df.columns.index(text_col)

    def compute():
        counter = _counter(data.value)

        def step(part):
            found = [counter.text(t or b"") for t in part.column(column).cast(pa.binary()).to_pylist()]
            return [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]

        return step

    return with_computed(df, [("n_words", "long"), ("n_tokens", "long")], compute)


def op6_wordpiece_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
