"""Secret scan with a ledger of blobs, so that each content meets each rule version once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm.common import Tables, private, text_slices

SPANS = "array<struct<kind: string, start: long, end: long>>"
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def _assign(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    if any(name in low for name in _NAMES):  # far cheaper than the expression
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                yield m.span()


def _whole(pattern: str, must: str = "") -> Callable[[str], Iterator[tuple[int, int]]]:
    found = re.compile(pattern)

    def spans(text: str) -> Iterator[tuple[int, int]]:
        if must in text:
            for m in found.finditer(text):
                yield m.span()

    return spans


@dataclass(frozen=True)
class Rule:
    """``version`` changes whenever what the rule finds changes."""

    kind: str
    version: int
    spans: Callable[[str], Iterator[tuple[int, int]]]

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The least lengths are part of the patterns where a shorter run holds no longer match.
BASE_RULES = (
    Rule("assign", 1, _assign),
    Rule("access", 1, _whole(r"AKIA[A-Z0-9]{16,}", "AKIA")),
    Rule("hex", 1, _whole(r"[0-9a-f]{24,}")),
)
MORE_RULES = (
    Rule("pem", 1, _whole(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]{0,40}PRIVATE KEY-----", "-----BEGIN ")),
    Rule("jwt", 1, _whole(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "eyJ")),
    Rule("bearer", 1, _whole(r"[Bb]earer\x20{1,8}[A-Za-z0-9._~+/-]{20,}=*", "earer ")),
    Rule("url", 1, _whole(r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,256}:[^\s/@]{1,256}@", "://")),
)
RULES = BASE_RULES + MORE_RULES


def in_order(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Spans by start, then by the order of the rules."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def _scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, text, todo) to (blob, rules, spans)."""
    by_key = {r.key: r for r in rules}
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            todo, found = part.column("todo").to_pylist(), []
            for text, keys in zip(part.column("text").to_pylist(), todo):
                chosen = [by_key[k] for k in keys]
                found.append([{"kind": r.kind, "start": a, "end": b} for r in chosen for a, b in r.spans(text)])
            arrays = [part.column("blob"), pa.array(todo, pa.list_(pa.string())), pa.array(found, pa.list_(span))]
            yield pa.RecordBatch.from_arrays(arrays, ["blob", "rules", "spans"])

    return blobs.select("blob", "text", "todo").mapInArrow(run, f"blob string, rules array<string>, spans {SPANS}")


def scan(
    spark: SparkSession,
    versions: DataFrame,
    ledger: str | None = None,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    tables: Tables | None = None,
) -> DataFrame:
    """Spans of secrets in every row of ``versions``: id, ``blob`` and ``spans``.

    Each text is addressed by its SHA-256. Of each blob, one text is fetched and scanned with the
    rules whose version the ledger does not have for it; the ledger, a folder of parquet files,
    gets the new results, blobs without findings included. The findings are then joined back to
    every row. Without ``ledger``, a fresh one is used. Spans are code points, end exclusive,
    leftmost and non-overlapping within a kind, sorted by start and then in the order of rules.

    The copies of one blob meet only as pairs of (blob, id), pre-aggregated in each task; texts
    are shuffled once, by blob and id, so that no task gets all copies of a text.

    Null and empty texts have no spans. Null and repeated ids pass through, each row with its
    own result. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "secrets")
    ledger = ledger or f"{tables.base}/ledger"
    keys = [r.key for r in rules]
    rows = versions.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    ).withColumn("blob", F.sha2(F.col("text").cast("binary"), 256))
    paths = tables.put(rows.select("id", "blob"), "paths")
    known = _ledger(spark, ledger)
    one = paths.groupBy("blob").agg(F.min("id").alias("id"))
    every = F.array(*[F.lit(k) for k in keys])
    if known is not None:
        seen = known.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        one = one.join(seen, "blob", "left").withColumn(
            "todo", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        )
    else:
        one = one.withColumn("todo", every)
    unseen = tables.put(one.filter(F.size("todo") > 0).select("blob", "id", "todo"), "unseen")
    todo = unseen.select(F.col("blob").alias("b"), F.col("id").alias("i"), "todo")
    texts = rows.join(todo, (F.col("blob") == F.col("b")) & F.col("id").eqNullSafe(F.col("i")))
    _scan_blobs(texts, rules).write.mode("append").parquet(ledger)
    found = (
        _ledger(spark, ledger)
        .select("blob", F.explode(F.filter("spans", lambda s: F.array_contains(F.array(*[F.lit(r.kind) for r in rules]), s["kind"]))).alias("span"), "rules")
        .filter(F.exists("rules", lambda k: F.array_contains(every, k) & k.startswith(F.concat(F.col("span.kind"), F.lit("@")))))
        .groupBy("blob")
        .agg(in_order(F.array_distinct(F.collect_list("span")), rules).alias("spans"))
    )
    empty = F.array().cast(SPANS)
    joined = paths.join(found, "blob", "left").select("id", "blob", F.coalesce("spans", empty).alias("spans"))
    return joined.withColumnRenamed("id", id_col)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(f"blob string, rules array<string>, spans {SPANS}").parquet(path)


def redact(spark: SparkSession, docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with each found span of ``text`` replaced by ``mark``; overlapping spans count as one.

    All rows and columns stay; ``n_chars`` follows a changed text. Texts without findings, null and empty ones included, are unchanged.
    """
    tables = options.pop("tables", None) or Tables(spark, "secrets")
    found = scan(spark, docs.select("doc_id", "text"), tables=tables, **options)
    blob, spans = private("blob", docs), private("spans", docs)
    marked = found.filter(F.size("spans") > 0).select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob])
    own = F.sha2(F.col("text").cast("binary"), 256)
    joined = docs.join(marked, own == F.col(blob), "left")
    clean = joined.withColumn("text", _masked(F.col("text"), F.col(spans), mark))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.char_length("text")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def _masked(text: Column, spans: Column, mark: str) -> Column:
    """Built-in expressions only: text between the spans, joined by the mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        before = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        fresh = F.struct(span["end"].alias("at"), F.concat(state["out"], before, F.lit(mark)).alias("out"))
        longer = F.struct(F.greatest(state["at"], span["end"]).alias("at"), state["out"].alias("out"))
        return F.when((span["start"] >= state["at"]), fresh).otherwise(longer)

    rest = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(spans.isNull(), text).otherwise(rest)
