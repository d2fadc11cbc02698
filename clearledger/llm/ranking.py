"""Ranked lexical search for a set of queries: equal bags of query terms are scored once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearledger.llm.common import Tables, text_slices

TOP = 10
BLOCK_ENTRIES = 500_000  # (item, term) pairs that one pass over the documents answers, on average
PIECE = 1 << 20
_CELLS = 1 << 21  # scores, and parts of scores, that a task holds at once
# Bytes that belong to terms, A-Z as a-z; all others separate them.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of bounded size."""
    data = text.encode().translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + PIECE)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


def _item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of every row, each once a row and task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            at, found = [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                own = {t for some in terms(text or "") for t in some}
                at += [i] * len(own)
                found += sorted(own)
            yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(at, pa.int64())), pa.array(found, pa.binary())], ["item_id", "term"])

    return items.mapInArrow(run, "item_id long, term binary").distinct()


def _bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms of a row counted, and its bag over the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in text_slices(batches):
            lengths, numbers, tfs = [], [], []
            for text in part.column("text").to_pylist():
                counts: Counter[bytes] = Counter()
                for some in terms(text or ""):
                    counts.update(some)
                lengths.append(counts.total())
                own = sorted((known[t], n) for t, n in counts.items() if t in known)
                numbers.append([t for t, _ in own])
                tfs.append([n for _, n in own])
            arrays = [part.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Postings:
    """Items and weight of each term of one block, as flat arrays."""

    def __init__(self, pairs: list[tuple[int, int]], weights: dict[int, int], n_items: int, n_terms: int):
        self.n_items = n_items
        by_term = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.items = by_term[:, 1]
        self.starts = np.searchsorted(by_term[:, 0], np.arange(n_terms + 1))
        self.weights = np.zeros(n_terms, dtype=np.int64)
        self.weights[list(weights)] = list(weights.values())

    def load(self, owner: np.ndarray, term: np.ndarray, n_classes: int) -> np.ndarray:
        """How many cells each class takes: its parts of scores, and a score for each item."""
        return np.bincount(owner, self.starts[term + 1] - self.starts[term], minlength=n_classes).astype(np.int64) + self.n_items

    def scores(self, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Scores of classes (rows) for items (columns), from entries (class, term, tf) and each
        class's ``m``, in 64-bit integers."""
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
        n = self.starts[term + 1] - self.starts[term]
        first = np.repeat(self.starts[term] - (np.cumsum(n) - n), n)
        items = self.items[first + np.arange(int(n.sum()))]
        total = np.zeros(len(m) * self.n_items, dtype=np.int64)
        np.add.at(total, np.repeat(owner * self.n_items, n) + items, np.repeat(part, n))
        return total.reshape(len(m), self.n_items)


def _best_first(rows: np.ndarray, top: int) -> np.ndarray:
    """Of rows (item, -score, no id, least id, class): the first ``top`` of each item."""
    rows = rows[np.lexsort(rows.T[::-1])]
    at = np.arange(len(rows))
    starts = np.searchsorted(rows[:, 0], rows[:, 0])
    return rows[at - starts < top]


def _score(classes: DataFrame, postings: Postings, top: int) -> DataFrame:
    """(item, score, class): of each item, the best classes of each task, equal scores by least id."""
    shared = classes.sparkSession.sparkContext.broadcast(postings)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        best = np.zeros((0, 5), dtype=np.int64)
        bar = np.ones(table.n_items, dtype=np.int64)  # least score that can still count
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            term = batch.column("terms").flatten().to_numpy().astype(np.int64)
            tf = batch.column("tfs").flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            m, no_id, least, cid = (batch.column(c).to_numpy() for c in ("m", "no_id", "least", "class"))
            ends = np.cumsum(table.load(owner, term, batch.num_rows))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _CELLS, "right")))
                e = slice(*np.searchsorted(owner, [lo, hi]))
                scores = table.scores(owner[e] - lo, term[e], tf[e], m[lo:hi])
                own, item = np.nonzero(scores >= bar)
                at = own + lo
                found = np.stack([item, -scores[own, item], no_id[at], least[at], cid[at]], axis=1)
                best = _best_first(np.concatenate([best, found]), top)
                full = best[np.bincount(best[:, 0], minlength=table.n_items)[best[:, 0]] >= top]
                np.maximum.at(bar, full[top - 1 :: top, 0], -full[top - 1 :: top, 1])
                lo = hi
        columns = [best[:, 0], -best[:, 1], best[:, 2], best[:, 3], best[:, 4]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item", "score", "no_id", "least", "class"])

    picked = classes.select("class", "no_id", "least", "m", "terms", "tfs")
    return picked.mapInArrow(run, "item long, score long, no_id long, least long, class long")


def _first(df: DataFrame, by: list[str], order: list[Column], top: int, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= top)


def rank(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    block_entries: int = BLOCK_ENTRIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    tables: Tables | None = None,
) -> DataFrame:
    """The ``top`` best rows of ``docs`` for each item: item, rank, doc id, score.

    1. Items are dealt over blocks by a hash, so many that a block has ``block_entries`` pairs of
       item and term on average: what tasks are given of a block does not grow with the items, nor
       with the documents. Each block is one pass over all documents.
    2. Each document becomes its length and its bag over the block's vocabulary; texts are not
       shuffled. Lengths and document frequencies are summed map-side first.
    3. Documents with the same length class ``m``, terms and frequencies are one class: grouped by
       a hash and, to verify it, by the bag itself, in each task first; so a bag that a third of
       all documents have is one row a task.
    4. Each class is scored once, in a few thousand rows of 64-bit integers at a time. A task
       keeps the ``top`` classes of each item, equal scores by their least id; ``top`` are enough,
       as each has a member that goes before all members of those left out.
    5. Only winning classes are expanded, to their ``top`` least ids, and ranked again.

    A term's weight, ``m`` and the score are those of the contract of ``op11_bag_deduplicated_search``.
    Documents without a term, null and empty texts have no score; items without a term, null and
    empty texts have no rows. Rows that repeat a document id are ranked each, null ids after all
    others; rows that repeat an item id are one item with the terms of all. Scores of 0 are left
    out. Equal scores go by ascending id. Other columns are ignored, whatever their names. Without
    documents or items there are no rows.
    """
    tables = tables or Tables(spark, "ranking")
    asked = tables.put(
        _item_terms(items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))),
        "item-terms",
    )
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    n_blocks = max(1, -(-asked.count() // block_entries))
    parts = [
        _rank_block(tables, source, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k), top) for k in range(n_blocks)
    ]
    return reduce(DataFrame.unionByName, parts).select(
        F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score"
    )


def _rank_block(tables: Tables, docs: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    spark = tables.spark
    pairs = asked.toArrow()  # of one block
    vocabulary = {t: i for i, t in enumerate(sorted(set(pairs.column("term").to_pylist())))}
    ids = pairs.column("item_id").to_pylist()
    items = {v: i for i, v in enumerate(sorted(set(ids), key=lambda v: (v is None, v)))}
    bags = tables.put(_bags(docs, vocabulary), "bags")
    totals = bags.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
    if not totals.docs or not vocabulary:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    weight = F.floor(1000 * F.log((2 * totals.docs + 2) / (2 * F.count("*") + 1)))
    counted = bags.select(F.explode("terms").alias("term")).groupBy("term").agg(weight.alias("w")).toArrow()
    weights = dict(zip(counted.column("term").to_pylist(), counted.column("w").to_pylist()))
    postings = Postings(
        [(vocabulary[t], items[i]) for t, i in zip(pairs.column("term").to_pylist(), ids)], weights, len(items), len(vocabulary)
    )
    m = (F.lit(100 - 90) + F.expr(f"(90L * n * {totals.docs}L) div {totals.length}L")).alias("m")
    members = bags.filter(F.size("terms") > 0).select("doc_id", m, "terms", "tfs")
    members = members.withColumn("bag", F.xxhash64("m", "terms", "tfs"))
    same = ["bag", "m", "terms", "tfs"]
    first = F.min(F.struct(F.col("doc_id").isNull().cast("long").alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("least"))).alias("first")
    classes = members.groupBy(*same).agg(first).select(*same, "first.no_id", "first.least")
    classes = tables.put(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    scored = _score(classes, postings, top)
    ahead = [F.desc("score"), F.asc("no_id"), F.asc("least")]
    winners = tables.put(_first(scored, ["item"], ahead, top).select("item", "score", "class"), "winners")
    chosen = classes.join(winners.select("class").distinct(), "class", "left_semi").select("class", *same)
    expanded = members.join(tables.put(chosen, "chosen"), same).select("class", "doc_id")
    expanded = _first(expanded, ["class"], [F.asc_nulls_last("doc_id")], top, "k").select("class", "doc_id")
    ranked = _first(winners.join(expanded, "class"), ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], top)
    names = spark.createDataFrame([(i, v) for v, i in items.items()], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
