from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelflight.llm import bpe_automaton, token_blocks
from shelflight.llm.common import new_path, tokenizer_file

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(2)
    letters = "aab bc  \n\t'sd ’é ß漢字😀01 23..!!  \x1c\x85ʰ́ ́"
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    out += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(160, 0x2fff), rng.randint(0x4e00, 0x4eff)])) for _ in range(12)) for _ in range(1500)]
    return out + ["a" * n for n in range(30)] + ["=" * 300, " " * 40 + "a", "x <|endoftext|> y<|endoftext|>", "<|endoftext|>", "it's we'll I'D"]


def test_automaton_gives_the_tokens_of_the_library(odd_texts):
    own, library = bpe_automaton.Codec(BYTES), Tokenizer.from_file(BYTES)
    for text in odd_texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_gadgets_by_hand():
    labels = {i: t for i, t in enumerate([b"a", b"b", b"ab", b"aa", b"aab"])}
    automaton = bpe_automaton.Automaton(labels, [(b"a", b"b"), (b"a", b"a"), (b"aa", b"b")])
    spelled = {w: [labels[i] for i in automaton.path(w)] for w in (b"ab", b"aab", b"aaab", b"aaa", b"ba")}
    # "aa" then "b" never meet: "ab" is merged first, so the third merge makes no path.
    assert spelled == {b"ab": [b"ab"], b"aab": [b"a", b"ab"], b"aaab": [b"aa", b"ab"], b"aaa": [b"aa", b"a"], b"ba": [b"b", b"a"]}


def test_two_merges_for_one_token_are_refused():
    labels = {i: t for i, t in enumerate([b"a", b"aa", b"aaa"])}
    with pytest.raises(ValueError):
        bpe_automaton.Automaton(labels, [(b"a", b"a"), (b"aa", b"a"), (b"a", b"aa")])


def test_digests_of_a_table(docs, empty):
    library = Tokenizer.from_file(BYTES)
    got = sorted(map(tuple, bpe_automaton.digests(docs).collect()), key=repr)
    want = []
    for doc, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe_automaton.digests(empty).count() == 0


def test_encode_then_decode(docs):
    ids = bpe_automaton.encode(docs)
    back = sorted(map(tuple, bpe_automaton.decode(ids).collect()), key=repr)
    assert back == sorted(((d, t or "") for d, t in docs.select("doc_id", "text").collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 129, 4097, 100_000])
def test_range_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), (rng.zipf(1.3, n) % 500).astype(np.int64), np.full(n, 7)):
        lanes, data = token_blocks.pack(ids, 49408)
        assert (token_blocks.unpack(n, lanes, data, 49408) == ids).all()


def test_contexts_make_blocks_smaller():
    rng = np.random.default_rng(1)
    phrases = [rng.integers(0, 49408, 12) for _ in range(40)]
    ids = np.concatenate([phrases[i] for i in rng.integers(0, 40, 20_000)])
    assert len(token_blocks.pack(ids, 49408)[1]) < len(ids) * 0.4


def test_halving_of_frequencies(monkeypatch):
    monkeypatch.setattr(token_blocks, "HALVE_AT", 60_000)
    ids = np.random.default_rng(3).integers(0, 300, 20_000)
    lanes, data = token_blocks.pack(ids, 49408)
    assert (token_blocks.unpack(len(ids), lanes, data, 49408) == ids).all()


def test_damaged_blocks_are_refused():
    block = token_blocks.block_bytes([1, None], [2, 1], np.array([5, 6, 2]), 49408)
    keys, counts, ids = token_blocks.read_block(block)
    assert (keys, list(counts), list(ids)) == ([1, None], [2, 1], [5, 6, 2])
    for at in (0, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_blocks.read_block(bytes(broken))


def test_blocks_of_a_table(spark, docs, corpus):
    library = Tokenizer.from_file(WORDS)
    folder = new_path(spark, "blocks")
    token_blocks.write_blocks(docs, folder, block_tokens=500)
    got = token_blocks.read_blocks(spark, folder, digest=True).collect()
    assert len(got) == len(corpus)
    at, seen = 0, []
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        seen.append(r["key"])
    assert seen == sorted(seen, key=lambda k: -1 if k is None else k)

    def row(doc, text):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        return doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted(((r["key"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == sorted((row(*r) for r in corpus), key=repr)
    whole = token_blocks.read_blocks(spark, folder).where("key = 500").first()
    assert whole["token_ids"] == [2]


def test_blocks_of_an_empty_table(spark, empty):
    folder = new_path(spark, "blocks")
    token_blocks.write_blocks(empty, folder)
    assert token_blocks.read_blocks(spark, folder).count() == 0


def test_word_memory_gives_the_ids_of_the_library(odd_texts):
    encoder, library = token_blocks.Encoder(WORDS), Tokenizer.from_file(WORDS)
    for text in odd_texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_columns_give_the_ids_of_the_library(odd_texts):
    encoder, library = token_blocks.Encoder(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(4)
    signs = "aEzZ\xdf\xc0\xdeÿŸİıſKÅ'sTL 12.,!-_\n\t\x0b\x1c\x85<|>’"
    texts = odd_texts + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", " ", "It'S <|ENDOFTEXT|> X<|StartOfText|>y İstanbul ÉCOLE über'LL", "word word, Word WORD!!"]
    column = pa.array(texts, pa.string())
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for part in (column, column.slice(1500), column.slice(len(texts) - 3), column.slice(0, 0)):  # once new, then remembered
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode_column(part)]
        assert got == want[part.offset:part.offset + len(part)]


def test_words_go_to_the_library_without_a_call_each(monkeypatch):
    encoder = token_blocks.Encoder(WORDS)
    calls = []

    class Counted:
        def encode_batch_fast(self, texts, **settings):
            calls.append(texts)
            return model.encode_batch_fast(texts, **settings)

    model, encoder.model = encoder.model, Counted()
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(9)) for _ in range(4000)]
    assert len(list(encoder.encode_column(pa.array([" ".join(words)])))) == 1
    assert len(calls) == 1
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in ("漢 Ş İ ŞİR", "’ Ž")] == [
        encoder.library.encode(t, add_special_tokens=False).ids for t in ("漢 Ş İ ŞİR", "’ Ž")]


def test_noise_among_phrases_costs_little():
    """Phrases with a tenth of noise, of which the coder before this one made 476,976 bytes."""
    rng = np.random.default_rng(6)
    phrases = (rng.zipf(1.2, (400, 30)) % 49408).astype(np.int64)
    ids = phrases[rng.integers(0, 400, 20_000)].reshape(-1)
    ids = np.where(rng.random(len(ids)) < 0.1, rng.integers(0, 49408, len(ids)), ids)
    lanes, data = token_blocks.pack(ids, 49408)
    assert (token_blocks.unpack(len(ids), lanes, data, 49408) == ids).all()
    assert len(data) < 473_000
