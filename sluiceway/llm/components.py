"""Connected components of a link table, by repeated contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.session import hand_over


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex, root`` of every vertex that has a link; vertices are longs, the root is one of them.

    Each round maps a vertex to the least of itself and its neighbours and rewrites the links with that map.
    Connected vertices stay connected, and of a component with two vertices or more at least one disappears,
    in practice most. Rounds end when no link is left. Every round is written to the shared folder, which cuts
    the lineage. Null ends and loops are ignored; repeated links count once. A vertex with very many links is
    one key of a join, which Spark splits at run time, and is aggregated in each task first.
    """
    edges = hand_over(
        links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where("a <> b")
        .distinct(),
        "links",
    )
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = hand_over(
            both.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("low")).select(
                "vertex", F.least("vertex", "low").alias("root")
            ),
            "contraction",
        )
        maps.append(least)
        left = least.select(F.col("vertex").alias("a"), F.col("root").alias("ra"))
        right = least.select(F.col("vertex").alias("b"), F.col("root").alias("rb"))
        edges = hand_over(
            edges.join(left, "a")
            .join(right, "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .where("a <> b")
            .distinct(),
            "links",
        )
    if not maps:
        return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    labels = maps[0]
    for step in maps[1:]:
        onward = step.select(F.col("vertex").alias("root"), F.col("root").alias("next"))
        labels = labels.join(onward, "root", "left").select("vertex", F.coalesce("next", "root").alias("root"))
    return labels
