"""A doc_id with two texts of equally many n-grams links by each of them."""

from __future__ import annotations

from scdstar.llm.jaccard import jaccard_classes


def test_links_by_each_text_of_an_id(spark):
    first, second = (" ".join(f"{c}{k}" for k in range(300)) for c in "ab")
    rows = [(1, first), (1, second), (2, first + " end"), (3, second + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    found = jaccard_classes(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (2, 1), (3, 1)]
