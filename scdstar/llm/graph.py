"""Connected components of links between documents, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scdstar.session import stage


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every end of ``links(a, b)``; the component is the smallest id.

    Each round takes the least label among neighbours and then the label's own label, so
    labels cover twice the distance each time. Minima combine before they are shuffled, so a
    document with very many links costs no more than others. Rounds are written tables.
    Null ends link nothing.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both, "links")
    labels = stage(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
        .select("id", F.least("id", "m").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m"))
        )
        step = labels.join(near, "id").select(
            "id", "component", F.least("component", "m").alias("nearer")
        )
        of_label = labels.select(F.col("id").alias("nearer"), F.col("component").alias("farther"))
        step = stage(
            step.join(of_label, "nearer")
            .select("id", F.least("nearer", "farther").alias("component"),
                    (F.least("nearer", "farther") < F.col("component")).alias("moved")),
            "labels",
        )
        labels = step.select("id", "component")
        if step.filter("moved").isEmpty():
            return labels
