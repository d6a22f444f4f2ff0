"""The pipeline against its plain version, stage by stage and as a whole; every query registered."""

from __future__ import annotations

import brute
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from shelflight.llm.common import tokenizer_file


@pytest.fixture(scope="module")
def folder(spark, docs, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    long_text = max((t for _, t in corpus if t), key=len).split(" ")
    items = [(1, " ".join(long_text[20:60])), (2, corpus[7][1]), (3, "changed")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def plain(corpus, items):
    """Rows of (id, text) after each stage."""
    rows = [(i, t) for i, t in corpus if any(c.isalpha() for c in t or "")]
    yield rows
    group = brute.groups(rows)
    rows = [(i, t) for i, t in rows if i is None or group[i] == i]
    rows = [r for k, r in enumerate(rows) if r[0] is None or r not in rows[:k]]
    yield rows
    rows = [(i, left.decode("utf-8", "ignore")) for (i, _), (left, _, _) in zip(rows, brute.cut(rows))]
    yield rows
    rows = [r for r, found in zip(rows, brute.contamination([t for _, t in rows], items)) if not found[4]]
    yield rows


def test_stages(spark, docs, corpus, folder):
    path, items = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain(corpus, items)):
        before = frame.columns
        frame = stage(spark, frame, path)
        frame.write.parquet(f"{path}/{name}")
        frame = spark.read.parquet(f"{path}/{name}")
        assert frame.columns == before
        got = frame.select("doc_id", "text", "n_chars").collect()
        assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted(want, key=repr), name
        if name == "repeats":
            assert all(r[2] == len(r[1]) for r in got)


def test_run(spark, corpus, folder):
    path, items = folder
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    *_, rows = plain(corpus, items)
    want = [(i, library.encode(t, add_special_tokens=False).ids) for i, t in rows]
    got = entry_points.queries()["pipeline"](spark, path).collect()
    assert sorted(((r.doc_id, r.token_ids) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_tokens == len(r.token_ids) for r in got)


def test_run_on_nothing(spark, folder, tmp_path):
    path, _ = folder
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_names():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
