"""The registered queries and the pipeline, on the smallest tables."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from check import connect, difference
from scdstar.llm.common import table
from scdstar.llm.queries import QUERIES, SQL

from awkward import awkward, sentence

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, small, name):
    expected = connect(small).execute(SQL[name]).df()
    assert difference(QUERIES[name](spark, small), expected) is None


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    code = "import sys, scdstar.queries, oracle.statements; assert not [m for m in sys.modules if m.startswith('scdstar.llm')]"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_each_stage_works_on_what_the_one_before_kept(spark, small):
    docs = table(spark, small, "documents")
    columns, whole = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = [set(whole)]
    for name, function in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(function(spark, docs, small), "test-stage")
        ids = Counter(r.doc_id for r in out.select("doc_id").collect())
        assert set(ids) <= kept[-1]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            assert all(r.text == whole[r.doc_id] for r in out.collect())
        else:
            assert ids == before and set(out.columns) == {"doc_id", "start", "n_tokens", "ids_crc32"}
        before = ids
        kept.append(set(ids))
        docs = out
    words = {i: set(zip(*[t.lower().split()[k:] for k in range(5)])) for i, t in whole.items()}
    items = duckdb.execute(f"SELECT text FROM '{small}/benchmark.parquet'").fetchall()
    leaks = {
        i for i in kept[2] for (t,) in items
        if len(words[i] & (s := set(zip(*[t.lower().split()[k:] for k in range(5)])))) >= 0.8 * len(s)
    }
    assert kept[3] == kept[2] - leaks
    near = [a for a in kept[2] for b in kept[2] if a < b and words[a] and
            5 * len(words[a] & words[b]) >= 4 * len(words[a] | words[b])]
    assert near == []


def test_an_empty_table_goes_through(spark, small, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, small, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_awkward_rows_go_through(spark, tmp_path):
    """Nulls, blank and very long texts, repeated rows, one id with two texts: what is left is the same
    on every run, and each row is a document of its own in the files."""
    rows = [(i, t, None if i == 11 else "en", "s", 0) for i, t in awkward()]
    spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(
        [(1, 1, 0), (8, 0, 0), (None, 1, 0), (3, None, None), (11, 1, 0), (11, 0, 1)],
        "doc_id bigint, quality bigint, toxic bigint",
    ).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(
        [(1, sentence(6, 30)), (None, None), (2, ""), (3, "no such passage in any of the texts")],
        "item_id bigint, text string",
    ).write.parquet(f"{tmp_path}/benchmark.parquet")
    first, second = (
        sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=lambda r: r[1])
        for _ in range(2)
    )
    assert first == second
    enough = Counter(i for i, t in set(awkward()) if len((t or "").split()) >= 50)
    assert {r[0] for r in first} <= set(enough)
    at = 0
    for _, start, n_tokens, _ in first:
        assert start == at
        at += n_tokens
    # Copies of 1 are gone, and so is the text of 20 that holds the benchmark item.
    assert not {2, 3} & {r[0] for r in first}
