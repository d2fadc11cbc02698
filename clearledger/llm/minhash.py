"""Near-duplicate documents by bottom-k sketches of their word shingles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm import linking
from clearledger.llm.common import Tables, slices
from clearledger.llm.shingles import fingerprint, many_shingles

KEPT = 32  # values of a sketch
LEAST_RARE = 22  # values of a full sketch that are in short lists
LEAST_OF_UNION = 10  # of KEPT values of a union's sketch, those that both sets have
_SIGN = np.uint64(1 << 63)
WHOLE = 24  # sets up to this size, and all that are similar to them, are whole in their sketches


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, k (a hash of id and text), n (size of its shingle set), two halves of the set's
    fingerprint, and the ``KEPT`` least hashes of the set."""
    source = _source(docs, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                made = many_shingles([t or "" for t in part.column("text").to_pylist()])
                one, two = zip(*map(fingerprint, made))
                least = [(x[:KEPT] ^ _SIGN).view(np.int64) for x in made]  # in the order of the hashes
                columns = [part.column("id"), part.column("k"), pa.array(list(map(len, made)), pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(least, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "k", "n", "one", "two", "least"])

    return source.mapInArrow(run, "id long, k long, n long, one long, two long, least array<long>")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, text); rows with the same id and text have the same ``k``."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.select("id", F.xxhash64("id", "text").alias("k"), "text")


def _document_texts(part: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    for i, k, text in zip(*(part.column(c).to_pylist() for c in ("id", "k", "text"))):
        if i is not None:
            yield k, text or ""


def _near_by_union(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose similarity, estimated by the sketch of their union, may reach 0.75.

    The ``KEPT`` least values of both sketches together are the sketch of the union; the share of
    them that both sets have is the estimate. A similar pair has under ``LEAST_OF_UNION`` with a
    chance of 1e-8.
    """
    sketch = lambda c: classes.select(F.col("cid").alias(c), F.col("least").alias(f"least_{c}"))
    both = pairs.join(sketch("a"), "a").join(sketch("b"), "b")
    union = F.slice(F.array_sort(F.array_union("least_a", "least_b")), 1, KEPT)
    common = F.array_intersect("least_a", "least_b")
    both = both.withColumn("of", F.least(F.size(F.array_union("least_a", "least_b")), F.lit(KEPT)))
    kept = F.size(F.array_intersect(union, common))
    return both.filter(kept * KEPT >= F.col("of") * LEAST_OF_UNION).select("a", "b", "n_a", "n_b")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tables: Tables | None = None
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (least id reachable by links) and ``kept``.

    Two documents link if the Jaccard similarity of their sets of five-word shingles is 0.75 or
    more, on the full sets of 64-bit shingle hashes.

    1. Equal sets are one class, by a 128-bit fingerprint, whatever the ids of its documents.
    2. Each class retains its ``KEPT`` least hashes, of one hash function. Inverted lists of
       retained values propose pairs: all pairs of short lists, which the sketch of their union
       filters.
    3. Long lists hold common passages or near copies. A similar pair differs in about 8 of 32 values,
       so where one of the two has ``LEAST_RARE`` values in short lists, they share one of those,
       but for a chance of 1e-7 at 0.75 (up to ``WHOLE`` values: for certain where over a third is in
       short lists). All other classes stay in their long lists, of which two similar ones always share
       one; those are met by centres, and what these leave by exact prefix keys, see ``linking``.
    4. Exact comparison of the full sets and distributed components, see ``linking``.

    No list, class or component is gathered in one task or on the driver.

    Null and empty texts have no shingle and link with nothing. Rows with a null id link with
    nothing and are kept. Rows that repeat an id are one document: they share its component.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "minhash")
    made = tables.put(sketches(docs, id_col, text_col), "sketches")
    full = made.filter("n > 0 and id is not null")
    by = ["one", "two", "n"]
    classes = full.groupBy(*by).agg(F.min("k").alias("cid"), F.min("id").alias("least_id"), F.first("least").alias("least"))
    classes = tables.put(classes, "classes")
    lists = linking.shared_keys_of(tables, classes.select(F.col("least").alias("key"), F.col("cid").alias("id"), "n"))
    is_short = F.col("size") <= linking.SHORT_LIST
    common = lists.filter(~is_short).groupBy("id", "n").agg(F.count("*").alias("common"))
    rare = F.least("n", F.lit(KEPT)) - F.col("common")
    poor = common.filter(F.when(F.col("n") <= WHOLE, 3 * rare <= F.col("n")).otherwise(rare < LEAST_RARE))
    left = tables.put(lists.filter(~is_short).join(poor.select("id"), "id", "left_semi").select("key", "id", "n", "size"), "poor")
    pairs = _near_by_union(linking.pairs_in_lists(lists.filter(is_short)).drop("shared"), classes)
    sets = linking.Sets(_source(docs, id_col, text_col), _document_texts, many_shingles)
    linked = linking.components_of(tables, sets, pairs, left)
    tables.drop(lists)
    at = linked.select(F.col("id").alias("cid"), "component")
    of_class = classes.select(*by, "cid", "least_id").join(at, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = of_class.groupBy("component").agg(F.min("least_id").alias("least_of"))
    of_class = of_class.join(least, "component").select(*by, F.col("least_of").alias("component"))
    direct = full.join(of_class, by)
    direct = direct.select("id", "component")
    reached = direct.groupBy("id").agg(F.min("component").alias("component_id"), F.max("component").alias("other"))
    reached = tables.put(reached, "reached")
    if not reached.filter("component_id != other").isEmpty():  # ids that repeat with other texts
        joined = linking.connected_components(
            tables, direct.select(F.col("id").alias("a"), F.col("component").alias("b"))
        )
        reached = joined.select("id", F.col("component").alias("component_id"))
    result = made.select("id", F.col("n").alias("n_shingles")).join(reached.select("id", "component_id"), "id", "left")
    component = F.coalesce("component_id", "id")
    return result.select("id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")).withColumnRenamed("id", id_col)
