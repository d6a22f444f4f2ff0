"""Operators on documents against plain versions, with nulls, empty, long and repeated rows."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelflight.llm import decontaminate, language_id, parity_join, shards, suffix_dedup
from shelflight.llm.common import new_path, stored


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# Language identification

def test_grams_by_hand():
    codes, often = language_id.counted(language_id.grams("Ab, ab!"))
    named = {}
    for c, n in zip(codes.tolist(), often.tolist()):
        letters = []
        while c:
            letters.append(chr(c & 0x1FFFFF))
            c >>= 21
        named["".join(reversed(letters))] = n
    assert named == {"a": 2, "b": 2, " a": 2, "ab": 2, "b ": 2, " ab": 2, "ab ": 2, "b a": 1}
    assert not len(language_id.grams("12 .. 34")) and not len(language_id.grams(None))


def test_out_of_place_distance_by_hand():
    a, b = (int(language_id.grams(c)[0]) for c in "ab")
    profiles = language_id.Profiles(("x", "y"), np.array([a, b]), np.array([[0, 1], [1, 0]]))
    # "aab" has "a" first; in list x that is place 0, in list y place 1.
    assert profiles.judge("aab")[0] == "x" and profiles.judge("abb")[0] == "y"
    assert profiles.judge("77") == ("und", 0.0) and profiles.judge(None) == ("und", 0.0)


def test_languages_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = language_id.held_out(F.col("doc_id"))
    got = language_id.identify(docs, language_id.learn(docs, ~kept)).withColumn("held_out", kept)
    rows = got.collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, docs, corpus, empty):
    profiles = language_id.learn(docs)
    got = language_id.identify(docs.withColumn("score", F.lit("x")), profiles)
    assert got.columns == [*docs.columns, "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert r["lang_pred"] == ("en" if any(c.isalpha() for c in r["text"] or "") else "und")
    nothing = language_id.learn(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(empty, profiles).count() == 0
    assert language_id.learn(docs.withColumn("lang", F.lit(None).cast("string"))).languages == ()


def test_learning_from_a_bounded_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert language_id.learn(docs, train_rows=200).languages == ("de", "en", "es", "fr")


# N-gram Jaccard join

def test_sketch_distance_never_exceeds_the_difference():
    rng = np.random.default_rng(0)
    for n in (1, 5, 40, 700):
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[: n * 4 // 5], rng.integers(0, 1 << 63, n // 3).astype(np.uint64))))
        one, other = parity_join.sketch(a), parity_join.sketch(b)
        size = min(len(one), len(other))
        apart = int(np.bitwise_count(parity_join.folded(one, size) ^ parity_join.folded(other, size)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(1)
    for _ in range(3000):
        n = int(rng.integers(1, 60 if rng.random() < 0.8 else 600))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        gone = rng.integers(0, n // 5 + 1)
        new = rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)
        b = np.unique(np.concatenate((rng.permutation(a)[gone:], new)))
        if parity_join.linked(a, b):
            assert len(np.intersect1d(parity_join.part_keys(a), parity_join.part_keys(b)))


def test_groups_of_a_table(docs, corpus, empty):
    want = brute.groups(corpus)
    got = plain(parity_join.similar_groups(docs, buckets=7), "doc_id", "n_shingles", "component_id")
    assert got == sorted(((i, len(brute.shingle_set(t)), want.get(i)) for i, t in corpus), key=repr)
    assert parity_join.similar_groups(empty).count() == 0


def test_links_that_the_least_document_lacks(spark, monkeypatch):
    """Chains and many versions of one text: similar neighbours, ends that are not."""
    monkeypatch.setattr(parity_join, "BLOCK", 4)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(200)]
    rows, text = [], words[:80]
    for k in range(40):
        rows.append((k * 7 % 40, " ".join(text)))
        text = list(text)
        text[rng.randrange(len(text))] = rng.choice(words)
    shared = " ".join(words[100:160])
    rows += [(100 + k, shared + " " + " ".join(f"u{k}-{i}" for i in range(k % 30 + 5))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.groups(rows)
    assert plain(parity_join.similar_groups(docs), "doc_id", "component_id") == sorted(want.items(), key=repr)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(7, 7)]
    got = dict(map(tuple, parity_join.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(20)}


# Suffix-array dedup

def test_previous_factors_by_hand():
    tail = b"0123456789" * 5
    text = np.frombuffer(tail + b"x" + tail + b"y" + tail, np.uint8)
    # Runs of documents 4, 2 and 4: the first and last have their text in document 2.
    run, at = suffix_dedup.previous_factors(text, np.array([0, 51, 102]), np.array([1, 1, 1]), np.array([4, 2, 4]))
    assert run.tolist() == [0, 2] and at.tolist() == [0, 0]


def test_runs_cover_every_position_once():
    rng = np.random.default_rng(2)
    for n in (50, 51, 90, 500):
        first, count, least = suffix_dedup.runs(rng.integers(97, 100, n).astype(np.uint8))
        assert first[0] == 0 and (first[1:] == (first + count)[:-1]).all() and first[-1] + count[-1] == n - 49


@pytest.mark.parametrize("batch", [1, 3000, 1 << 24])
def test_cuts_of_a_table(docs, corpus, empty, monkeypatch, batch):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "BATCH_SPANS", 10)
    want = [(i, len((t or "").encode()), n, k, hashlib.sha256(left).hexdigest()) for (i, t), (left, n, k) in zip(corpus, brute.cut(corpus))]
    got = plain(suffix_dedup.digests(docs, buckets=5), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(want, key=repr)
    assert suffix_dedup.digests(empty).count() == 0


def test_cut_keeps_other_columns_and_whole_characters(spark):
    shared = "é" * 30
    rows = [(1, "a" + shared, 5), (2, "bé" + shared + "ü", 6), (3, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = sorted(map(tuple, suffix_dedup.cut(docs).collect()))
    # The first byte of "ü" is that of "é", so it ends a string that document 1 has too.
    assert got == [(1, "a" + shared, 5), (2, "b", 6), (3, None, 7)]


# Benchmark decontamination

@pytest.mark.parametrize("bits", [decontaminate.FILTER, 64])
def test_contamination_of_a_table(spark, docs, corpus, bits):
    long_text = max((t for _, t in corpus if t), key=len).split(" ")
    items = [(1, " ".join(long_text[50:90])), (2, " ".join(long_text[70:83])), (3, "Stone, the-river of"), (4, "word"), (5, None), (6, "..."),
             (None, " ".join(long_text[10:40])), (2, " ".join(long_text[75:99])), (9, "changed"), (10, "a b"), (11, " ".join(long_text[70:83]))]
    items += [(20 + k, t) for k, (_, t) in enumerate(corpus[:5])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination([t for _, t in corpus], items)
    got = decontaminate.mark(docs, benchmark, bits=bits)
    assert set(docs.columns) - {"n_words"} <= set(got.columns)
    assert plain(got, "doc_id", *decontaminate.OUTPUTS) == sorted(((i, *w) for (i, _), w in zip(corpus, want)), key=repr)


def test_contamination_with_empty_tables(spark, docs, empty):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate.mark(empty, benchmark).count() == 0
    assert decontaminate.mark(docs, benchmark.where("false")).where("contaminated OR n_hit > 0").count() == 0


# Sharding

def test_rare_languages_and_rows_without_key_are_learned(spark):
    rows = [(i, f"aba bab {'abcdefghij'[i % 10]}", "x") for i in range(4000)] + [(k, "wuw uwu", "rare") for k in (5000, 5001, 5002)]
    rows += [(None, "qoq oqo " + "z" * (i + 1), "keyless") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.learn(docs, train_rows=40)
    assert found.languages == ("keyless", "rare", "x")
    assert [found.judge(t)[0] for t in ("wuw", "qoq", "aba")] == ["rare", "keyless", "x"]


def check_shards(rows, limit):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r)
    for name, members in by_shard.items():
        assert sum(r["n_bytes"] for r in members) == members[0]["shard_bytes"] and len(members) == members[0]["shard_rows"]
        assert members[0]["shard_bytes"] <= limit or len(members) == 1
    names = sorted(n[1:] for n in by_shard)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    # Only buckets over the limit were split: what two sibling shards hold together is too large for one.
    for n in names:
        if n:
            inside = [r for m, rs in by_shard.items() if m[1:].startswith(n[:-1]) for r in rs]
            assert sum(r["n_bytes"] for r in inside) > limit and len(inside) > 1


@pytest.mark.parametrize("limit", [1 << 30, 4000, 300, 1])
def test_shards_fit_and_split_only_when_needed(spark, docs, corpus, limit):
    folder = new_path(spark, "shards")
    source = docs.coalesce(1)
    shards.write_shards(source, folder, limit=limit)
    rows = shards.read_shards(source, folder).collect()
    assert sorted(((r["doc_id"], r["text"], r["source"]) for r in rows), key=repr) == sorted(
        ((r["doc_id"], r["text"], r["source"]) for r in docs.collect()), key=repr)
    check_shards(rows, limit)


def test_equal_rows_are_split_too(spark):
    docs = spark.createDataFrame([(1, "x" * 100)] * 50, "doc_id long, text string").coalesce(1)
    folder = new_path(spark, "shards")
    shards.write_shards(docs, folder, limit=500)
    rows = shards.read_shards(docs, folder).collect()
    assert len(rows) == 50
    check_shards(rows, 500)


def test_equal_rows_that_are_split_differently_when_read_again(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "x" * 50)] * 400, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/equal")
    whole = shards.directory

    def and_split_anew(sized, limit):
        found = stored(whole(sized, limit), "directory")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        return found

    monkeypatch.setattr(shards, "directory", and_split_anew)
    source, folder = spark.read.parquet(f"{tmp_path}/equal"), new_path(spark, "shards")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        shards.write_shards(source, folder, limit=500)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    rows = shards.read_shards(source, folder).collect()
    assert len(rows) == 400
    check_shards(rows, 500)


def test_no_rows_no_shards(spark, empty):
    folder = new_path(spark, "shards")
    assert shards.write_shards(empty, folder).count() == 0
    assert shards.read_shards(empty, folder).count() == 0
