"""Language identification in two steps: the family, then one language of it."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearledger.llm.common import text_slices

# Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fy", "lb", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
}
UNKNOWN = "und"
BUCKETS = 4096
SAMPLE_PER_LANGUAGE = 500
_STEPS = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII in lower case, all but letters as spaces; the bytes of other characters stay.
_PLAIN = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang.split("-")[0] in members), lang)


def features(text: str) -> np.ndarray:
    """Square roots of the shares of hashed runs of two and three bytes, as a unit vector."""
    b = np.frombuffer(f" {text.lower()} ".encode().translate(_PLAIN), dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(263) + b[2:]
    mixed = np.concatenate([two * np.uint32(2654435761), three * np.uint32(2246822519)]) >> np.uint32(20)
    counts = np.sqrt(np.bincount(mixed, minlength=BUCKETS).astype(np.float32))
    return counts / max(1e-9, float(np.sqrt((counts * counts).sum())))


def _descend(weights: np.ndarray, gradient, steps: int = 300, rate: float = 0.5, momentum: float = 0.9) -> np.ndarray:
    speed = np.zeros_like(weights)
    for _ in range(steps):
        speed = momentum * speed - rate * gradient(weights)
        weights = weights + speed
    return weights


class Model:
    """Softmax over families, then votes of one linear support vector machine a pair."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(lang) for lang in self.langs})
        self.members = [[i for i, lang in enumerate(self.langs) if family_of(lang) == f] for f in self.families]
        x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
        lang = np.array([self.langs.index(v) for v in langs])
        family = np.array([self.families.index(family_of(v)) for v in langs])
        self.by_family = self._softmax(x, family, len(self.families))
        self.pairs = {
            (a, b): self._machine(x[(lang == a) | (lang == b)], np.where(lang[(lang == a) | (lang == b)] == a, 1.0, -1.0))
            for members in self.members
            for a, b in combinations(members, 2)
        }

    @staticmethod
    def _weights(labels: np.ndarray) -> np.ndarray:
        """Each class counts the same."""
        _, at, n = np.unique(labels, return_inverse=True, return_counts=True)
        return (1.0 / n[at] / len(n)).astype(np.float32)

    def _softmax(self, x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        share, hot = self._weights(y)[:, None], np.eye(k, dtype=np.float32)[y]

        def gradient(w: np.ndarray) -> np.ndarray:
            z = x @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            return x.T @ (share * (p - hot)) + 1e-5 * w

        return _descend(np.zeros((x.shape[1], k), dtype=np.float32), gradient, rate=4.0)

    def _machine(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Squared hinge loss."""
        share, y = self._weights(y), y.astype(np.float32)

        def gradient(w: np.ndarray) -> np.ndarray:
            return -2 * (x.T @ (share * y * np.maximum(0, 1 - y * (x @ w)))) + 1e-4 * w

        return _descend(np.zeros(x.shape[1], dtype=np.float32), gradient)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        x = np.append(x, np.float32(1))
        z = (x @ self.by_family).astype(np.float64)
        p = np.exp(z - z.max())
        family = int(np.argmax(p))
        members, sure = self.members[family], float(p[family] / p.sum())
        votes = dict.fromkeys(members, 0.0)
        for a, b in combinations(members, 2):
            chance = 1 / (1 + np.exp(-3 * float(x @ self.pairs[a, b])))
            votes[a] += chance
            votes[b] += 1 - chance
        best = max(members, key=lambda m: (votes[m], -m))
        return self.langs[best], sure * (votes[best] / (len(members) - 1) if len(members) > 1 else 1.0)


def train(docs: DataFrame, learn: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Model of the languages in rows of ``docs`` (doc_id, text, lang) where ``learn`` holds.

    Fitted on ``per_language`` rows of each language at most, those with the least hash of their
    id and text, so the driver gets that many vectors of fixed length, however often an id or a row repeats.
    Rows are thinned out by a bound on the hash first, from the counts of the languages, so that
    only about twice as many rows as are taken meet by language. None where there is no such row.
    """
    known = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    hashed = known.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.pmod("h", F.lit(_STEPS)) * F.col("n") < F.lit(_STEPS) * (2 * per_language + 50)
    thinned = hashed.join(F.broadcast(counts), "lang").filter(share).drop("n")  # a row a language
    order = Window.partitionBy("lang").orderBy("h")
    sample = thinned.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= per_language).select("lang", "text")

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [features(t).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(found, pa.binary())], ["lang", "x"])

    rows = sample.mapInArrow(vectors, "lang string, x binary").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("lang", "ascending"), ("x", "ascending")])  # the same sums whatever the order of tasks
    x = np.empty((rows.num_rows, BUCKETS), dtype=np.float32)
    for i, value in enumerate(rows.column("x")):
        x[i] = np.frombuffer(value.as_buffer(), dtype=np.float32)
    return Model(x, rows.column("lang").to_pylist())


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``lang_pred`` and ``score`` (0 to 1) of each whole text: id, lang_pred, score.

    ``und`` with score 0 where the text is null or has no letter, or where ``model`` is None. One
    pass over the rows without a shuffle. Null and repeated ids pass through; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [
                model.predict(features(t)) if model and t and _LETTER.search(t) else (UNKNOWN, 0.0)
                for t in part.column("text").to_pylist()
            ]
            langs, scores = zip(*found)
            arrays = [part.column("id").cast(arrow_id), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "lang_pred", "score"])

    schema = f"id {id_type.simpleString()}, lang_pred string, score double"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def label(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` after its own columns, otherwise as ``identify``.

    The text goes to Python as a column of its own beside the row, so rows need no key.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index(text_col)]).cast("string"))
    types = plain.schema.fields

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [
                model.predict(features(t)) if model and t and _LETTER.search(t) else (UNKNOWN, 0.0)
                for t in part.column("text").to_pylist()
            ]
            langs, scores = zip(*found)
            columns = [*part.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "lang_score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in types[:-1])
    out = plain.mapInArrow(run, f"{schema}, lang_pred string, lang_score double")
    return out.toDF(*docs.columns, "lang_pred", "lang_score")
