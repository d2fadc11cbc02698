"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearledger.llm.common import Memo, text_slices

MAX_TRAINING_DOCS = 20_000
MAX_FEATURES = 4096
_BUCKETS = 1 << 20
_GRAM = 5
_MEMO_WORDS = 400_000
_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_ENDS = ".!?\n"


def word_features(word: str) -> set[int]:
    """Hashed: the whole word, and its runs of five characters with both ends marked."""
    marked = f"^{word}$"
    grams = {marked, *(marked[i : i + _GRAM] for i in range(max(1, len(marked) - _GRAM + 1)))}
    return {zlib.crc32(g.encode()) & (_BUCKETS - 1) for g in grams}


def sentences(text: str) -> Iterator[list[str]]:
    """Words of each sentence that has any, in lower case."""
    words: list[str] = []
    for token in _TOKEN.findall(text.lower()):
        if token in _ENDS:
            if words:
                yield words
            words = []
        else:
            words.append(token)
    if words:
        yield words


class Model:
    """Chance of each sentence from the weights of its words' features, and of a text from them."""

    def __init__(self, bias: float, weights: dict[int, float]):
        self.bias, self.weights = bias, weights
        self._ready()

    def _ready(self) -> None:
        self.words = Memo(self._word, _MEMO_WORDS)

    def __getstate__(self):
        return self.bias, self.weights

    def __setstate__(self, state):
        self.bias, self.weights = state
        self._ready()

    def _word(self, token: str) -> float:
        if token in _ENDS:
            return np.inf
        return float(sum(self.weights.get(f, 0.0) for f in word_features(token)))

    def sentence_logits(self, text: str) -> np.ndarray:
        """Of each sentence with a word."""
        tokens = _TOKEN.findall(text.lower())
        values = np.fromiter(map(self.words.__getitem__, tokens), dtype=np.float64, count=len(tokens))
        words = ~np.isinf(values)
        if not words.any():
            return np.zeros(0)
        number = np.cumsum(~words)[words]
        _, starts = np.unique(number, return_index=True)
        return self.bias + np.add.reduceat(values[words], starts)

    def score(self, text: str) -> float:
        return float(-np.expm1(-np.logaddexp(0, self.sentence_logits(text)).sum()))


def _sample(docs: DataFrame, labels: DataFrame, learn: Column, most: int) -> DataFrame:
    """(doc_id, y, text) of ``most`` labelled documents at most, those with the least hash of
    their id; of an id with several texts, the greatest."""
    known = labels.filter(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    found = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.max("text").alias("text"))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, max_docs: int = MAX_TRAINING_DOCS, max_features: int = MAX_FEATURES
) -> Model:
    """Fit to ``labels`` (doc_id, toxic) of rows of ``docs`` (doc_id, text) where ``learn`` holds.

    A sample of ``max_docs`` labelled documents at most is used, each once, however often its id
    repeats. In tasks, the features are counted by
    label, and the ``max_features`` most telling ones kept; then the sentences of the sample that
    hold any of these are fitted on the driver, as flat arrays of the numbers of their features. Without labelled
    rows of both kinds, every text gets the share of toxic ones among those there are, or 0.
    """
    sample = _sample(docs, labels, learn, max_docs)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_label, seen = (Counter(), Counter()), [0, 0]
        known = Memo(word_features, _MEMO_WORDS // 4)
        for part in text_slices(batches):
            for y, text in zip(part.column("y").to_pylist(), part.column("text").to_pylist()):
                found: set[int] = set()
                for word in set(w for s in sentences(text) for w in s):
                    found |= known[word]
                by_label[y].update(found)
                seen[y] += 1
        keys = [-1, *by_label[0].keys() | by_label[1].keys()]
        by_label[0][-1], by_label[1][-1] = seen
        columns = [pa.array(keys, pa.int64()), *[pa.array([c[k] for k in keys], pa.int64()) for c in by_label]]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "n0", "n1"])

    counts = sample.mapInArrow(count, "feature long, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = counts.filter((F.col("n0") + F.col("n1") >= 3) | (F.col("feature") == -1)).cache()
    try:
        totals = counts.filter("feature = -1").collect()
        n0, n1 = (totals[0].n0 or 0, totals[0].n1 or 0) if totals else (0, 0)
        if not n0 or not n1:
            share = (n1 / (n0 + n1)) if n0 + n1 else 0.0
            return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))), {})
        more = F.log((F.col("n1") + 0.5) / (n1 + 1.0)) - F.log((F.col("n0") + 0.5) / (n0 + 1.0))
        telling = (F.col("n1") * more).alias("telling")
        top = counts.filter("feature >= 0 and n1 > 0").select("feature", more.alias("more"), telling).filter("more > 1.0")
        chosen = {r.feature: r.more for r in top.orderBy(F.desc("telling"), "feature").limit(max_features).collect()}
    finally:
        counts.unpersist()
    return _fit(sample, chosen, n1 / (n0 + n1))


def _fit(sample: DataFrame, chosen: dict[int, float], share: float) -> Model:
    column = {f: i for i, f in enumerate(sorted(chosen))}

    def bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memo(lambda w: [column[f] for f in word_features(w) if f in column], _MEMO_WORDS // 4)
        for part in text_slices(batches):
            empty, sizes, features = [], [], []
            for text in part.column("text").to_pylist():
                full = [[f for w in s for f in known[w]] for s in sentences(text)]
                empty.append(sum(not s for s in full))
                sizes.append([len(s) for s in full if s])
                features.append([f for s in full for f in s])
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            arrays = [part.column("doc_id"), part.column("y"), *[pa.array(c, t) for c, t in zip((empty, sizes, features), kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "y", "empty", "sizes", "features"])

    schema = "doc_id long, y int, empty long, sizes array<int>, features array<int>"
    plain = sample.select(F.col("doc_id").cast("long"), "y", "text")
    rows = plain.mapInArrow(bags, schema).toArrow().sort_by("doc_id").combine_chunks()  # flat arrays of numbers
    y, empty = (rows.column(c).to_numpy().astype(np.float64) for c in ("y", "empty"))
    n_full = np.array([len(x) for x in rows.column("sizes")], dtype=np.int64)
    flat = lambda c: np.concatenate([x.flatten().to_numpy() for x in rows.column(c).chunks] or [np.zeros(0)]).astype(np.int64)
    sizes, feature = flat("sizes"), flat("features")
    doc = np.repeat(np.arange(len(y)), n_full)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    theta = np.array([0.3 * chosen[f] for f in sorted(chosen)] + [-6.0])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, 301):
        z = theta[-1] + np.bincount(sentence, theta[feature], minlength=len(sizes))
        p, p_empty = np.exp(-np.logaddexp(0, -z)), np.exp(-np.logaddexp(0, -theta[-1]))
        none = empty * np.logaddexp(0, theta[-1]) + np.bincount(doc, np.logaddexp(0, z), minlength=len(y))
        clean = np.exp(-none)
        # Slope of the log-likelihood by the log chance of a clean document.
        slope = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-6), 1.0) / len(y)
        by_sentence = slope[doc] * p
        gradient = np.append(np.bincount(feature, by_sentence[sentence], minlength=len(column)), by_sentence.sum() + (slope * empty).sum() * p_empty)
        gradient[:-1] += 1e-5 * theta[:-1]
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta = theta - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Model(float(theta[-1]), dict(zip(sorted(chosen), theta[:-1].tolist())))


def score(
    docs: DataFrame, model: Model, worst: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``score`` (0 to 1) of each whole text, and ``sentences``: the numbers (from 0, among
    sentences with a word) and chances of its ``worst`` most toxic ones.

    One pass over the rows without a shuffle. Null and empty texts score 0. Null and repeated ids
    pass through; other columns are ignored, whatever their names; an empty table gives no rows.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType
    arrow_id = to_arrow_type(id_type)
    place = pa.struct([("sentence", pa.int64()), ("chance", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            scores, places = [], []
            for text in part.column("text").to_pylist():
                logits = model.sentence_logits(text or "")
                scores.append(float(-np.expm1(-np.logaddexp(0, logits).sum())))
                top = np.argsort(-logits, kind="stable")[:worst]
                places.append([{"sentence": int(i), "chance": float(np.exp(-np.logaddexp(0, -logits[i])))} for i in top])
            arrays = [part.column("id").cast(arrow_id), pa.array(scores, pa.float64()), pa.array(places, pa.list_(place))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "score", "sentences"])

    schema = f"id {id_type.simpleString()}, score double, sentences array<struct<sentence: long, chance: double>>"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
