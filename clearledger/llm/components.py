"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearledger.llm.common import Tables


def connected_components(tables: Tables, links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the least id that its links reach.

    Each round, every id points to the least of itself and its neighbours, and pointers are
    followed twice; then links are drawn between what their ends point to, loops and repeats
    dropped. Ids only ever point to lesser ones, and every round at least halves the ids that
    still have links, so the rounds grow with the logarithm of the input. Least neighbours are
    found in each task first, so a hub reaches its reducer as one row a task; joins on a hub are
    split by adaptive execution. Every round is written out, which cuts the lineage.

    Loops, repeated and null links are ignored; no link gives no row.
    """
    ends = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    edges = tables.put(links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter(ends).distinct(), "edges")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("to"))
        least = tables.put(least, "least")
        if least.isEmpty():
            break
        onward = least.select(F.col("id").alias("to"), F.col("to").alias("next"))
        moved = tables.put(least.join(onward, "to").select("id", F.col("next").alias("to")), "moved")
        if labels is None:
            labels = moved.withColumnRenamed("to", "component")
        else:
            step = moved.select(F.col("id").alias("component"), "to")
            labels = labels.join(step, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
        labels = tables.put(labels, "labels")
        at_a, at_b = (moved.select(F.col("id").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        drawn = edges.join(at_a, "a").join(at_b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        before, edges = edges, tables.put(drawn.filter("a != b").distinct(), "edges")
        tables.drop(before)
    if labels is None:
        return least.select("id", F.col("to").alias("component"))
    return labels
