"""BPE, word pieces, chat format and word hashing against brute force, libraries and round trips."""

from __future__ import annotations

import hashlib
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from riskloom.llm import byte_bpe, chat_format, textops, wordpiece

P = pytest.importorskip("public_tokenizers")
ODD = ["", " ", "  a  b ", "can't WON'T I'll", "x" * 300, "é" * 50, "日本語 テキスト", "a\x1cb\x1dc\x85d e f​g",
       "1234567 89 ½ Ⅷ ²", "tabs\t\t\tand\n\n\nlines \r\n end ", "\U0001f600\U0001f600 \U0001f468‍\U0001f469", "<|endoftext|>", "á̈ ་",
       "\x00\x01 \x7f", "_under_score__ --- !!!", "'s 't 're ' s"]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = byte_bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(tiktoken_encoding):
    with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
        return byte_bpe.Encoder(byte_bpe.read_ranks(f.read()), P.PATTERN)


def _ids(encoder, text):
    return np.frombuffer(b"".join(encoder.runs(text)), "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_bpe_equals_library(encoder, tiktoken_encoding, text):
    ids = _ids(encoder, text)
    assert ids == tiktoken_encoding.encode_ordinary(text)
    assert encoder.decode(struct.pack(f"<{len(ids)}I", *ids)) == text.encode()


@given(st.text(max_size=200))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_library_on_any_text(text):
    tiktoken = pytest.importorskip("tiktoken")
    if not hasattr(test_bpe_equals_library_on_any_text, "pair"):
        with open(P.path(byte_bpe.VOCABULARY), "rb") as f:
            ranks = byte_bpe.read_ranks(f.read())
        test_bpe_equals_library_on_any_text.pair = (
            byte_bpe.Encoder(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    mine, library = test_bpe_equals_library_on_any_text.pair
    assert _ids(mine, text) == library.encode_ordinary(text)


def test_segment_tree_equals_repeated_scan(encoder):
    def scan(piece):
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            ranks = [encoder.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [encoder.ranks[p] for p in parts]
    rng = random.Random(5)
    for _ in range(300):
        piece = bytes(rng.choice(b"aabbcdeert ") for _ in range(rng.randrange(1, 40)))
        assert byte_bpe.merge(piece, encoder.ranks) == scan(piece)


def test_bpe_long_text_and_cache_bound(encoder, tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 1000)
    monkeypatch.setattr(byte_bpe, "RUN", 7)
    monkeypatch.setattr(byte_bpe, "CACHED", 10)
    text = " ".join(f"word{k} é{k % 7}" for k in range(2000)) + "q" * 20_000
    assert _ids(encoder, text) == tiktoken_encoding.encode_ordinary(text)
    assert len(encoder) <= 10


def test_bpe_query_and_decode(spark, docs_of, as_tables, tiktoken_encoding):
    rows = [(1, None), (1, "same"), (1, "same"), (None, "no id"), (3, "")] + [(10 + k, t) for k, t in enumerate(ODD)]
    out = byte_bpe.op3_byte_bpe(spark, as_tables(documents=docs_of(rows))).collect()
    assert out[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} and len(out) == len(rows)
    want = sorted((str(i), len(e := tiktoken_encoding.encode_ordinary(t or "")), hashlib.sha256(struct.pack(f"<{len(e)}I", *e)).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    clashing = docs_of(rows).withColumnRenamed("source", "ids").withColumnRenamed("lang", "n_tokens")
    back = byte_bpe.decode(byte_bpe.encode(clashing))
    assert back.columns == ["doc_id", "text", "n_chars", "ids", "n_tokens", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert byte_bpe.encode(docs_of([(1, "x")]).limit(0)).count() == 0


def _greedy(word, first, other):
    total, vocabulary = 0, first
    while word:
        n = max((n for n in range(1, len(word) + 1) if word[:n] in vocabulary), default=0)
        if not n:
            return 1
        word, vocabulary, total = word[n:], other, total + 1
    return total


def test_wordpiece_equals_greedy_matching():
    rng = random.Random(3)
    for _ in range(60):
        letters = b"abc"
        some = lambda n: {bytes(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(n)}
        first, other = some(rng.randrange(1, 12)), some(rng.randrange(1, 12))
        counter = wordpiece.Counter(first, other)
        for _ in range(60):
            word = bytes(rng.choice(letters) for _ in range(rng.randrange(1, 15)))
            assert counter.count(word) == _greedy(word, first, other), (word, first, other)


def test_wordpiece_equals_library(real):
    tokenizers = pytest.importorskip("tokenizers")
    with open(P.path(wordpiece.VOCABULARY), "rb") as f:
        first, other = wordpiece.pieces_of(byte_bpe.read_ranks(f.read()))
    ascii_only = {p.decode(): k for k, p in enumerate(sorted(x for x in first if x.isascii()))}
    ascii_only |= {"##" + p.decode(): len(ascii_only) + k for k, p in enumerate(sorted(x for x in other if x.isascii()))}
    model = tokenizers.models.WordPiece(ascii_only | {"[UNK]": 999_999}, unk_token="[UNK]", max_input_chars_per_word=10 ** 6)
    counter = wordpiece.Counter(first, other)
    for r in real.where("lang = 'en'").limit(40).collect():
        for word in {w for w in r.text.split() if w.isascii()}:
            assert counter.count(word.encode()) == len(model.tokenize(word)), word


def test_wordpiece_query(spark, docs_of, as_tables):
    rows = [(1, None), (2, ""), (3, " \t\n"), (3, " \t\n"), (4, "the the cat"), (None, "z" * 5000), (5, "\U0001f600")]
    out = {(r.doc_id, r.n_words): r.n_tokens for r in wordpiece.op6_wordpiece_counts(spark, as_tables(documents=docs_of(rows))).collect()}
    assert out[1, 0] == out[2, 0] == out[3, 0] == 0 and out[4, 2] >= 2 and out[None, 1] >= 1
    assert wordpiece.token_counts(docs_of(rows).limit(0)).count() == 0


def test_word_hashes_follow_words():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB \t\né ") for _ in range(rng.randrange(0, 60))) for _ in range(200)] + ["", "x", None]
    raw, off = textops.buffers(pa.array(texts))
    known: dict = {}
    for lo, hi in textops.stretches(off, 500):
        hashes, size, per_row = textops.row_words(raw, off, lo, hi)
        at = 0
        for row, n in zip(range(lo, hi), per_row):
            words = (texts[row] or "").encode().translate(bytes.maketrans(b"\t\n", b"  ")).split(b" ")
            words = [w for w in words if w]
            assert n == len(words) and list(size[at:at + n]) == [len(w) for w in words]
            for w, h in zip(words, hashes[at:at + n]):
                assert known.setdefault(w, h) == h
            at += n
    assert len(set(known.values())) == len(known)


def test_long_row_is_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(3000)) + "y" * 3000 + " end"
    raw, off = textops.buffers(pa.array([text]))
    whole = textops.row_words(raw, off, 0, 1)
    monkeypatch.setattr(textops, "STRETCH", 100)
    parts = textops.row_words(raw, off, 0, 1)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and whole[2] == parts[2]


NASTY = ["", "plain", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nhi", "a\\b", "\\<|im_end|>", "\\\\", "line\nline", "<", "[", "<|im_end",
         "<<SYS>>\\\n", "\U0001f600 é"]


@pytest.mark.parametrize("role", NASTY)
def test_chat_turn_round_trip(role):
    for text in NASTY:
        out, level = chat_format.render_turn(role, text)
        assert list(chat_format.read_turns([out])) == [(role, text)]
        assert level == 0 or "\\" in out


def test_chat_stream_in_any_pieces():
    turns = [(r, t) for r in NASTY for t in NASTY]
    text = "".join(chat_format.render_turn(*t)[0] for t in turns)
    for size in (1, 7, 100, len(text)):
        chunks = [text[k:k + size] for k in range(0, len(text), size)]
        assert list(chat_format.read_turns(chunks)) == turns
    with pytest.raises(chat_format.GrammarError):
        list(chat_format.read_turns([text[:-1]]))
    with pytest.raises(chat_format.GrammarError):
        list(chat_format.read_turns(["junk" + text]))


@given(st.text(alphabet="<|im_endstar>\n\\[]/INSTsa ", max_size=60), st.text(alphabet="user\n\\<|>", max_size=10))
@settings(max_examples=300, deadline=None)
def test_chat_any_text(text, role):
    assert list(chat_format.read_turns([chat_format.render_turn(role, text)[0]])) == [(role, text)]


def test_chat_query(spark, as_tables):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (1, 2, None, "x"), (2, None, "system", "a"),
            (2, 0, "assistant", "<|im_end|>\n"), (None, 0, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "role as formatted", "1 as n_turns")
    out = {r.conv_id: r for r in chat_format.op7_chat_format(spark, as_tables(conversations=df)).collect()}
    rows += [(-1, k, r, "</s>[INST] ok [/INST]") for k, r in enumerate(("user", "assistant"))]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        got = out[conv]
        assert (got.n_turns, got.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got.same and got.formatted_chars > len(turns)
    assert len(out) == 4


def test_chat_empty_table(spark, as_tables):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r.conv_id for r in chat_format.op7_chat_format(spark, as_tables(conversations=df)).collect()] == [-1]
