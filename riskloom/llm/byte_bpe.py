"""Byte-level BPE encoding and decoding.

Text is split by the tokenizer's pattern; each match is merged on its own.  A
segment tree over the byte positions of a match holds, at the position where a
live part starts, the rank of the pair it forms with its right neighbour; every
node keeps the smaller rank of its two halves and the left one on a tie.  The
root names the leftmost pair of least rank; merging it updates three leaves
(the merged part, its dead right half, its left neighbour) in logarithmic time.

Ids are kept as little-endian unsigned 32-bit integers in a binary column.
Decoding joins the tokens' bytes.

Cases: a null text is encoded as empty (no ids); rows that repeat an id are
separate rows; an empty table gives an empty result; other columns pass
through, and columns with the names of new ones are replaced.  A text of over
``LONG`` characters is encoded in runs of matches, so its pieces are never all
held at once.  Matches of over ``KEPT`` characters are not cached; a cache of
about ``CACHED`` bytes becomes the old one, whose entries return when they are met
again, so the frequent ones stay.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskloom.llm.common import KEPT as WORKER_STATE, table, with_computed

VOCABULARY = "byte_bpe_50k.tiktoken"
LONG, RUN, KEPT, CACHED = 1 << 20, 1 << 16, 64, 36 << 20
#: Bytes that an entry of the cache takes besides its ids: two objects and a place in the table.
_ENTRY = 140
_NONE = 1 << 62


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Rank file: one base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match."""
    n = len(piece)
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    get = ranks.get
    size = 1 << (n - 2).bit_length()
    tree = [_NONE] * size + [get(piece[i:i + 2], _NONE) for i in range(n - 1)] + [_NONE] * (size - n + 1)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a <= b else b
    after, before = list(range(1, n + 2)), list(range(-1, n))
    while tree[1] != _NONE:
        i = 1
        while i < size:
            i *= 2
            if tree[i] > tree[i + 1]:
                i += 1
        at = i - size
        dead = after[at]
        end = after[dead]
        after[at] = end
        before[end] = at
        left = before[at]
        points = [(at, get(piece[at:after[end]], _NONE) if end < n else _NONE)]
        if dead < n - 1:
            points.append((dead, _NONE))
        if left >= 0:
            points.append((left, get(piece[left:end], _NONE)))
        for place, rank in points:
            i = size + place
            tree[i] = rank
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                if a > b:
                    a = b
                if tree[i] == a:
                    break
                tree[i] = a
                i >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:after[at]]])
        at = after[at]
    return ids


class Encoder(dict):
    """Match -> ids as bytes, filled on demand."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.tokens: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        # white space by its Unicode property, as the tokenizer's own regex engine has it
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        plain = (pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\t-\r A-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]")
                 .replace(r"\p{N}", "[0-9]").replace(r"\s", r"[\t-\r ]").replace(r"\S", r"[^\t-\r ]"))
        self.split_ascii = re.compile(plain) if r"\p" not in plain else self.split

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()
        if len(piece) <= KEPT:
            if self.held >= CACHED:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self[piece] = ids
            self.held += _ENTRY + len(ids) + len(piece)
        return ids

    def runs(self, text: str) -> Iterator[bytes]:
        """Ids of ``text`` as bytes, in runs."""
        split = self.split_ascii if text.isascii() else self.split
        if len(text) <= LONG:
            yield b"".join(map(self.__getitem__, split.findall(text)))
        else:
            for run in batched((m.group() for m in split.finditer(text)), RUN):
                yield b"".join(map(self.__getitem__, run))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoders: dict[tuple[bytes, str], Encoder] = WORKER_STATE.setdefault("byte_bpe", {})


def _encoder(data: bytes, pattern: str) -> Encoder:
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(data), pattern)
    return _encoders[key]


def _vocabulary(path: str | None, pattern: str | None) -> tuple[bytes, str]:
    if path is None or pattern is None:
        import public_tokenizers
        path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    with open(path, "rb") as f:
        return f.read(), pattern


#: What encode() can return: the ids, their number and digests of the ids and of what they decode to.
OUTPUTS = {"ids": "binary", "n_tokens": "long", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}


def encode(df: DataFrame, text_col: str = "text", outputs: Iterable[str] = ("ids", "n_tokens"),
           path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the named columns of OUTPUTS; the vocabulary file (about 1 MB)
    is read by the driver and broadcast."""
    outputs = list(outputs)
    data, pattern = _vocabulary(path, pattern)
    data = df.sparkSession.sparkContext.broadcast(data)
    column = df.columns.index(text_col)

    def compute():
        encoder = _encoder(data.value, pattern)
        back = any(o.startswith("decoded") for o in outputs)

        def one(text: str | None) -> tuple:
            size, ids, out = 0, [], []
            hashed, decoded = hashlib.sha256(), hashlib.sha256()
            for run in encoder.runs(text or ""):
                size += len(run) // 4
                hashed.update(run)
                if "ids" in outputs:
                    ids.append(run)
                if back:
                    piece = encoder.decode(run)
                    decoded.update(piece)
                    if "decoded" in outputs:
                        out.append(piece)
            row = {"ids": b"".join(ids), "n_tokens": size, "ids_sha256": hashed.hexdigest(), "decoded": b"".join(out),
                   "decoded_sha256": decoded.hexdigest()}
            return tuple(row[o] for o in outputs)

        def step(part):
            rows = [one(text) for text in part.column(column).to_pylist()]
            kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
            return [pa.array([r[k] for r in rows], kinds[OUTPUTS[o]]) for k, o in enumerate(outputs)]

        return step

    return with_computed(df, [(o, OUTPUTS[o]) for o in outputs], compute, "byte_bpe")


def decode(df: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the bytes that the ids of ``ids_col`` stand for; null ids stay null."""
    data, pattern = _vocabulary(path, None)
    data = df.sparkSession.sparkContext.broadcast(data)
    column = df.columns.index(ids_col)

    def compute():
        encoder = _encoder(data.value, pattern)
        return lambda part: [pa.array([None if x is None else encoder.decode(x) for x in part.column(column).to_pylist()],
                                      pa.binary())]

    return with_computed(df, [(out_col, "binary")], compute)


def op3_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, outputs=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")
