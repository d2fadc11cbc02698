"""K-d tree sharding: split at weighted medians along the widest metadata dimension."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearledger.llm.common import Tables, unsigned_crc32

MAX_LEAVES = 65_536
_DIGITS = 3  # hexadecimal digits that a round settles: 4096 counts a node
_DIMENSION, _CRC, _TIE, _ROW = 8, 8, 10, 16  # digits of the parts of a key


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def default_dimensions() -> dict[str, Column]:
    """Text length, language and source, each as a number below 2**32."""
    return {
        "chars": F.char_length(F.coalesce("text", F.lit(""))).cast("long"),
        "lang": unsigned_crc32(F.coalesce("lang", F.lit(""))),
        "source": unsigned_crc32(F.coalesce("source", F.lit(""))),
    }


def _table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A few rows as a table, built by expressions."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")))


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.hex(value), digits, "0")


def _medians(spark: SparkSession, rows: DataFrame, nodes: list[dict]) -> list[dict]:
    """Cut of each node, a string: the keys below it are those up to the weighted quantile, which is
    the least key with ``part`` of the node's bytes up to it (half of them: the median). If that is
    the node's greatest key, the cut is before it; so both sides have rows.

    ``rows`` has node, key, size; no two rows have the same key. Each round sums the bytes by the
    next digits of the keys that still begin like the median, map-side first, and keeps the digits
    that hold the half, until one row has them; so a round moves 4096 sums a node and task at
    most, and one row a node reaches the driver.
    """
    state = [{"node": n["node"], "total": n["bytes"], "half": n["part"], "prefix": "", "below": 0} for n in nodes]
    cuts = []
    for done in range(0, _DIMENSION + _CRC + _TIE + _ROW, _DIGITS):
        if not state:
            break
        at = F.broadcast(_table(spark, state, "node: long, total: long, half: long, prefix: string, below: long"))
        same = [F.first(c).alias(c) for c in ("total", "half", "prefix", "below")]
        sums = (
            rows.join(at, "node")
            .filter(F.substring("key", 1, done) == F.col("prefix"))
            .groupBy("node", F.substring("key", done + 1, _DIGITS).alias("digits"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *same)
        )
        order = Window.partitionBy("node").orderBy("digits")
        upto = sums.withColumn("upto", F.col("below") + F.sum("bytes").over(order))
        first = upto.filter((F.col("upto") >= F.col("half")) & (F.col("upto") - F.col("bytes") < F.col("half")))
        found = first.select("node", "total", "half", "prefix", "digits", "upto", "bytes", "n").collect()
        state = []
        for r in found:
            prefix = r.prefix + r.digits
            if r.n > 1:
                state.append({"node": r.node, "total": r.total, "half": r.half, "prefix": prefix, "below": r.upto - r.bytes})
            else:
                cuts.append({"node": r.node, "cut": prefix if r.upto == r.total else prefix + "g"})
    return cuts


def shard(
    spark: SparkSession,
    docs: DataFrame,
    target_bytes: int | None = None,
    n_shards: int | None = None,
    dimensions: Mapping[str, Column] | None = None,
    id_col: str = "doc_id",
    tables: Tables | None = None,
) -> DataFrame:
    """``shard`` and ``slot`` of every row, with its ``size``, ``text_crc32`` and ``key``.

    The whole table is to become ``n_shards`` leaves, or as many as reach ``target_bytes``. A node
    of more than one is split at the weighted median (at the like quantile, where its number of
    leaves is odd) along its widest dimension, which is that of the greatest range against the
    range of the whole table. Its two sides share its leaves by their bytes, each at least one and at most one a row, and are
    split on until they are one leaf each. So there are exactly as many leaves as asked for, or one a row if
    there are fewer rows; a row larger than a leaf's share is a leaf with few others or none. Rows that tie on the dimension are ordered by the crc32 of their text, so that equal texts stay
    together, then by a hash of the id, then by a number of the row; so a value or an equal row that
    holds a third of all rows is split like any other. ``dimensions`` are columns of non-negative numbers below 2**32.

    Only id, size, key and dimensions, never texts, are written or shuffled. The driver sees one
    row a node, ``MAX_LEAVES`` at most. Slots are gapless from 0 in each shard, ordered by key:
    rows are range-partitioned by shard and key, numbered where they lie, and shifted by the
    counts of the partitions before.

    Null texts count as empty. Null and repeated ids pass through. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "sharding")
    chosen = dict(dimensions or default_dimensions())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [f"d{i}" for i in range(len(chosen))]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        size_of(text).alias("size"),
        unsigned_crc32(text).alias("crc"),
        *[F.coalesce(F.least(c, F.lit(2**32 - 1)), F.lit(0)).cast("long").alias(n) for n, c in zip(names, chosen.values())],
    ).withColumn("node", F.lit(1).cast("long"))
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("id"), 24)).withColumn("row", F.monotonically_increasing_id())
    rows = tables.put(rows, "rows")
    spread = [F.min(n).alias(f"lo_{n}") for n in names] + [F.max(n).alias(f"hi_{n}") for n in names]
    whole, leaves, last = None, {1: 1}, 1
    path, sides = {1: ""}, []
    while True:
        found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), *spread).collect()}
        if not found:
            break
        if whole is None:
            whole = found[1]
            leaves[1] = n_shards or max(1, round(whole.bytes / target_bytes))
            if leaves[1] > MAX_LEAVES:
                raise ValueError(f"more than {MAX_LEAVES} shards; raise target_bytes")
        for parent, left, right in sides:
            leaves[left], leaves[right] = _shares(leaves.pop(parent), found[left], found[right])
        wide = [r for r in found.values() if r.n > 1 and leaves[r.node] > 1]
        if not wide:
            break
        part = lambda r, n: (r[f"hi_{n}"] - r[f"lo_{n}"]) / max(1, whole[f"hi_{n}"] - whole[f"lo_{n}"])
        nodes, sides = [], []
        for r in wide:
            k = leaves[r.node]
            dim = max(range(len(names)), key=lambda i: (part(r, names[i]), -i))
            nodes.append({"node": r.node, "bytes": r.bytes, "part": -(-r.bytes * (k // 2) // k), "dim": dim, "left": last + 1, "right": last + 2})
            sides.append((r.node, last + 1, last + 2))
            path[last + 1], path[last + 2] = path[r.node] + "0", path[r.node] + "1"
            last += 2
        chosen_dim = F.broadcast(_table(spark, nodes, "node: long, dim: int, left: long, right: long"))
        along = F.element_at(F.array(*names), F.col("dim") + 1)
        keyed = rows.join(chosen_dim, "node", "left").withColumn("key", F.concat(_key(along), _hex(F.col("row"), _ROW)))
        medians = _medians(spark, keyed.filter("dim is not null").select("node", "key", "size"), nodes)
        cut = F.broadcast(_table(spark, medians, "node: long, cut: string"))
        side = F.when(F.col("cut").isNull(), F.col("node")).when(F.col("key") < F.col("cut"), F.col("left")).otherwise(F.col("right"))
        split = keyed.join(cut, "node", "left").withColumn("node", side).drop("dim", "key", "cut", "left", "right")
        before, rows = rows, tables.put(split.select(*rows.columns), "split")
        tables.drop(before)
    shards = sorted(found, key=path.__getitem__)
    numbers = _table(spark, [{"node": n, "shard": i} for i, n in enumerate(shards)] or [{"node": 0, "shard": 0}], "node: long, shard: int")
    placed = rows.join(F.broadcast(numbers), "node").select("id", "size", F.col("crc").alias("text_crc32"), "shard", "row", _key(F.col(names[0])).alias("key"))
    return _slots(tables, placed).withColumnRenamed("id", id_col)


def _key(along: Column) -> Column:
    return F.concat(_hex(along, _DIMENSION), _hex(F.col("crc"), _CRC), _hex(F.col("tie"), _TIE))


def _shares(leaves: int, left, right) -> tuple[int, int]:
    """How many of a node's leaves its two sides get: by bytes, at least one and at most one a row."""
    own = round(leaves * left.bytes / (left.bytes + right.bytes))
    own = max(1, leaves - right.n, min(own, leaves - 1, left.n))
    return own, max(1, leaves - own)


def _slots(tables: Tables, placed: DataFrame) -> DataFrame:
    dealt = (
        placed.repartitionByRange("shard", "key", "row")
        .sortWithinPartitions("shard", "key", "row")
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id())
    )
    stored = tables.put(dealt, "dealt")
    runs = stored.groupBy("shard", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    starts = runs.select("shard", "part", (before - F.col("first")).alias("shift"))
    return stored.join(F.broadcast(starts), ["shard", "part"]).select(
        "id", "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot"), "key"
    )
