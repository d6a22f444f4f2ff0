"""Packing, vector codes and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelflight.llm import filter_audit, packing, token_blocks, vector_codes
from shelflight.llm.common import tokenizer_file

WORDS = tokenizer_file("word_bpe_49k.json")


# Packing

def check_sequences(pieces, size):
    """Pieces of (sequence, offset, length) fill sequences without gaps; returns the tokens of padding."""
    by_sequence = {}
    for s, offset, length in pieces:
        by_sequence.setdefault(s, []).append((offset, length))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return padding


@pytest.mark.parametrize("size, seed", [(1, 0), (7, 1), (64, 2), (64, 3), (100, 4), (2048, 5)])
def test_plan_places_every_token_once(size, seed):
    rng = random.Random(seed)
    histogram = {}
    for _ in range(rng.choice([1, 5, 3000])):
        length = min(size, max(1, int(rng.expovariate(3 / size))))
        histogram[length] = histogram.get(length, 0) + rng.choice([1, 1, 50])
    plan, pieces = packing.plan(histogram, size), []
    for length, n in histogram.items():
        for rank in range(n):
            parts = list(plan.place(length, rank))
            assert sum(taken for taken, _, _ in parts) == length
            pieces += [(s, offset, taken) for taken, s, offset in parts]
    assert check_sequences(pieces, size) == (0 if size & (size - 1) == 0 else pytest.approx(0, abs=size))
    assert len({s for s, _, _ in pieces}) == plan.sequences


def test_emptiest_packs_come_first_and_patterns_stay_few():
    plan = packing.plan({6: 2, 3: 4, 1: 4}, 14)
    # 28 tokens: two packs. Sixes go one to each, threes two to each, ones two to each.
    assert plan.steps == {6: [(0, 2, 0, 0, 6, -1)], 3: [(0, 2, 0, 6, 3, -1)], 1: [(0, 2, 0, 12, 1, -1)]}
    rng = np.random.default_rng(0)
    few = packing.plan({n: int(c) for n, c in enumerate(rng.integers(1, 10**9, 2049)) if n})
    assert sum(map(len, few.steps.values())) < 200_000


def test_plan_of_many_short_pieces_and_of_none():
    assert packing.plan({}).sequences == 0
    plan = packing.plan({1: 10**6 + 5})
    assert plan.sequences == (10**6 + 5) // 2048 + ((10**6 + 5) % 2048).bit_count() and sum(map(len, plan.steps.values())) < 10_000
    cut = packing.plan({1100: 1000})
    assert check_sequences([(s, o, t) for r in range(1000) for t, s, o in cut.place(1100, r)], 2048) == 0


@pytest.mark.parametrize("size", [64, 2048])
def test_packed_table(spark, docs, corpus, size):
    library = Tokenizer.from_file(WORDS)
    pieces = packing.pack(docs, size=size)
    got = pieces.collect()
    assert check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], size) == 0
    found = {}
    for r in sorted(got, key=lambda r: (repr(r["doc_id"]), r["start"])):
        found.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    want = {}
    for doc, text in corpus:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault((doc, len(ids)), []).append(ids)
    assert set(found) == set(want)
    for name, of_doc in found.items():
        if len(want[name]) == 1:  # repeated rows share their pieces' names
            assert [x for r in of_doc for x in r["token_ids"]] == want[name][0]
            assert [r["start"] for r in of_doc] == list(itertools.accumulate([0] + [r["length"] for r in of_doc]))[:-1]
        assert sum(r["length"] for r in of_doc) == sum(map(len, want[name]))
    digests = packing.pack(docs, size=size, digest=True).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    key = lambda r: repr(tuple(r[:6]))
    assert [r["ids_crc32"] for r in sorted(digests, key=key)] == [crc(r["token_ids"]) for r in sorted(got, key=key)]
    rows = packing.sequences(pieces, size, pad_id=9).collect()
    assert all(len(r["token_ids"]) in (size, r["n_tokens"]) for r in rows)
    assert sum(r["n_tokens"] for r in rows) == sum(r["length"] for r in got)


def test_packing_of_nothing_and_of_one_row(spark, empty):
    assert packing.pack(empty).count() == 0
    one = spark.createDataFrame([(None, None, "x")], "doc_id long, text string, length string")
    assert [tuple(r) for r in packing.pack(one).collect()] == [(None, 0, 1, 1, 0, 0, [1])]


def test_a_third_of_all_rows_with_one_length(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same words here").otherwise(
        F.concat_ws(" ", F.array_repeat(F.lit("river"), F.col("id").cast("int") % 90))).alias("text")).repartition(5)
    got = packing.pack(rows, size=128).collect()
    assert check_sequences([(r["sequence_id"], r["offset"], r["length"]) for r in got], 128) == 0
    assert sum(r["length"] for r in got) == sum({r["doc_id"]: r["doc_tokens"] for r in got}.values())


def test_columns_of_texts_give_the_ids_of_the_library(corpus):
    import pyarrow as pa

    encoder, library = token_blocks.Encoder(WORDS), Tokenizer.from_file(WORDS)
    texts = [t for _, t in corpus] + ["<|endoftext|> x<|STARTOFTEXT|>", "a\x0bb\x1cc\x85d\xa0e  ", "It's I'LL don't", "é ́e ́", "Ünder-word,x 12,3"]
    for _ in range(2):
        got = list(encoder.encode_column(pa.array(texts, pa.string())))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


# Vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Codes, errors, errors by label and codebooks; rows of (id, vector, label), the vector's components whole numbers of 1/4096."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    seeds = sorted(((i, v) for i, v, _ in kept if i is not None))[:entries]
    d = len(seeds[0][1]) // parts
    cut = lambda v: [v[p * d:(p + 1) * d] for p in range(parts)]
    books = [[cut(v)[p] for _, v in seeds] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min(range(len(book)), key=lambda e: (apart(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(near(cut(v)[p], books[p]), []).append(cut(v)[p])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else books[p][e] for e in range(len(books[p]))]
    out, by_label = [], {}
    for i, v, lab in kept:
        codes = [near(x, book) for x, book in zip(cut(v), books)]
        error = sum(apart(x, book[c]) for x, book, c in zip(cut(v), books, codes))
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, bytes(codes).hex(), error, lab))
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, c, min(e, vector_codes.MOST), min(by_label[lab], vector_codes.MOST), digest) for i, c, e, lab in out), key=repr)


@pytest.mark.parametrize("n, d, spread", [(1, 8, 1.0), (9, 16, 1.0), (150, 16, 0.001), (150, 24, 2.0), (40, 8, 1e5), (40, 8, 1e25)])
def test_codes_against_all_distances(spark, n, d, spread):
    rng = random.Random(n + d)
    rows = [(i, [rng.gauss(0, spread) for _ in range(d)], i % 3 or None) for i in range(n)]
    rows += [rows[0], (None, rows[0][1], 1), (500, None, 1), (501, [None] * d, 2), (502, [math.inf] + [0.0] * (d - 1), 2), (503, [math.nan] * d, 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int").repartition(3)
    assert sorted(map(tuple, vector_codes.coded(df).collect()), key=repr) == plain_codes(rows)


def test_search_stops_early_and_keeps_ties():
    rng = np.random.default_rng(3)
    book = rng.integers(-40, 40, (16, 4))
    book[9] = book[2]
    x = np.concatenate((rng.integers(-40, 40, (500, 4)), book))
    code, best, seen = vector_codes.nearest(x, book)
    away = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    assert (code == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()
    assert seen < 0.8 * len(x) * len(book)
    wide = vector_codes.nearest(x.astype(object) * 10**15, book.astype(object) * 10**15)
    assert (wide[0] == code).all() and (wide[1] == best.astype(object) * 10**30).all()


def test_vectors_of_other_lengths_and_no_vectors(spark):
    rows = [(1, [0.5] * 8, 1), (2, [1.0] * 16, 1), (3, [], None), (4, [2.0] * 8, 1), (0, [1.0] * 3, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in vector_codes.coded(df).collect()}
    assert got == {1: ("00" * 8, 0, 0), 4: ("01" * 8, 0, 0), 2: (None, None, 0), 3: (None, None, None), 0: (None, None, 0)}
    assert vector_codes.coded(df.where("false")).count() == 0
    assert [r["code"] for r in vector_codes.coded(df.where("vec_id = 1").withColumn("vec_id", F.lit(None).cast("long"))).collect()] == [None]
    books = vector_codes.fit(df)
    back = vector_codes.decode(vector_codes.encode(df, books), books).where("vec_id = 4").first()
    assert back["decoded"] == [2.0] * 8


# Filter audit

def plain_audit(rows, labels):
    """One row per part, order and step, by removing documents filter by filter."""
    known = {}
    for i, q, t in labels:
        a, b = known.get(i, (0, 0))
        known[i] = (max(a, int(q == 1)), max(b, int(t == 1)))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    told = []
    for i, t, s in rows:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {f for f, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)), i is not None and least[text] < i)) if bad}
        told.append((s or "", failed, known.get(i, (0, 0)) if i is not None else (0, 0)))
    out = []
    for part in {p for p, _, _ in told}:
        rows_of, lost = [], {f: 0 for f in "ABCDE"}
        for order in itertools.permutations("ABCDE"):
            left = [(f, k) for p, f, k in told if p == part]
            gone = []
            for step, f in enumerate(order, 1):
                hit = [x for x in left if f in x[0]]
                redundant = sum(f in x[0] for x in gone)
                left = [x for x in left if f not in x[0]]
                gone += hit
                lost[f] += len(hit)
                rows_of.append([part, "".join(order), step, len(left), len(hit), redundant, sum(x == {f} for p, x, _ in told if p == part),
                                sum(k[0] for _, k in hit), sum(k[1] for _, k in hit)])
        out += [tuple([*r, lost[r[1][r[2] - 1]]]) for r in rows_of]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_audit_of_a_table(spark, corpus, monkeypatch, small):
    if small:  # many tries, long prefixes
        monkeypatch.setattr(filter_audit, "TRIE_BYTES", 300)
        monkeypatch.setattr(filter_audit, "PREFIX_BYTES", 600)
    rng = random.Random(1)
    rows = [(i, t, [None, "", "a", "b", "a"][k % 5]) for k, (i, t) in enumerate(corpus)]
    rows += [(900 + k, "A" * (k % 4) + " b#" * (k % 3), "a") for k in range(40)] + [(None, "dup", "b"), (999, "dup", "b"), (998, "dup", "b"), (998, "dup", "b")]
    begin = " ".join(f"w{i}" for i in range(60))
    rows += [(2000 + k, f"{begin} end{k % 20}", "b") for k in range(60)] + [(2100, begin, "b"), (2101, begin, "b"), (2102, begin + " ", "b")]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i, _, _ in rows] + [(None, 1, 1), (1, 1, 0), (1, 0, 1), (77777, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, mask int, place string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filter_audit.audit(docs, marks).collect())) == plain_audit(rows, labels)


def test_audit_without_rows_or_labels(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, none).count() == 0
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    rows = filter_audit.audit(one, none).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}
    assert {(r["step"], r["removed"]) for r in rows if r["filter_order"] == "ABCDE"} == {(1, 1), (2, 0), (3, 0), (4, 0), (5, 0)}


def test_trie_keeps_whole_texts():
    rng = random.Random(0)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(400)] + [b"x" * 5000, b"x" * 5001]
    trie, want = filter_audit.Trie(), {}
    for k, t in enumerate(texts):
        trie.insert(t).end(1000 - k, 1)
        want.setdefault(t, []).append(1000 - k)
    assert sorted((n.least, n.copies) for n in trie.terminals()) == sorted((min(v), len(v)) for v in want.values())
