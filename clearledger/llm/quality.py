"""Line-frequency quality rules, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm.common import Tables

# What separates words, and the symbols that are counted.
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MAX_DOCS_PER_HOST = 10
LEAST_SHARE_LEFT = 0.5


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, runs of white space as one space, trimmed."""
    spaced = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), "[ \\t-\\r]+", " ")
    return F.trim(spaced)


def _n_repeat_words(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from ``words``: words inside 3-word windows that occur twice.

    Windows are compared by a 64-bit hash. Only rows that have a repeated one are sorted to find
    where it stands. Each step is a column of its own, so that arrays are built once a row.
    """
    last = F.size("words") - 3
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    rows = rows.withColumn("__w", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)))
    rows = rows.withColumn("__again", F.size("__w") > F.size(F.array_distinct("__w")))
    placed = F.sort_array(F.transform("__w", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    rows = rows.withColumn("__s", F.when(F.col("__again"), placed))
    beside = lambda x, i: (x["h"] == F.get("__s", i - 1)["h"]) | (x["h"] == F.get("__s", i + 1)["h"])
    at = F.sort_array(F.transform(F.filter("__s", beside), lambda x: x["at"]))
    rows = rows.withColumn("__at", at)
    new = lambda p, i: F.least(F.lit(3), F.coalesce(F.get("__at", i + 1), p + 3) - p)
    total = F.aggregate(F.transform("__at", new), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0))).drop("__w", "__again", "__s", "__at")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Base counts of each row, and ``lines``: hash and words of each of its lines with a word."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select(
        "id",
        "host",
        words_of(F.col("text")).alias("words"),
        F.char_length(F.translate("text", SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.translate(x, SEPARATORS, "") != "").alias("parts"),
    )
    rows = _n_repeat_words(rows)
    line = lambda x: F.struct(F.xxhash64(normal_line(x)).alias("hash"), F.size(words_of(x)).alias("words"))
    return rows.select(
        "id",
        "host",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("parts") - F.size(F.array_distinct("parts"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform("parts", line).alias("lines"),
    )


def judge(
    spark: SparkSession,
    docs: DataFrame,
    max_docs: int = MAX_DOCS_PER_HOST,
    least_left: float = LEAST_SHARE_LEFT,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    tables: Tables | None = None,
) -> DataFrame:
    """Base counts, ``base_failed``, ``words_left`` and ``kept`` of each row.

    A line is frequent on a host if more than ``max_docs`` of the host's documents have it, after
    ``normal_line``. A document is kept unless it fails the base rules (under 50 words, or more
    than half of its words in repeated 3-word windows) or less than ``least_left`` of its words
    are left without its frequent lines. ``removed`` holds the hashes of those lines.

    Texts are read once; what is written and shuffled are hashes of lines, once a document. The
    documents of a host and line are counted in each task first, so a line or a host that a third
    of all rows have reaches its reducer as one row a task; rows then meet only the frequent
    lines, where adaptive execution splits a skewed key.

    Null texts have no words; a null host is a host of its own. Repeated rows count as documents
    of their own. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "quality")
    stored = tables.put(
        measure(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()), "measured"
    )
    lines = stored.select("row", "host", F.explode("lines").alias("line")).select("row", "host", "line.hash", "line.words")
    once = stored.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    frequent = once.groupBy("host", "hash").agg(F.count("*").alias("n")).filter(F.col("n") > max_docs).select("host", "hash")
    lost = lines.join(frequent, ["host", "hash"], "left_semi").groupBy("row").agg(
        F.sum("words").alias("lost"), F.collect_set("hash").alias("removed")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    joined = stored.join(lost, "row", "left")
    return joined.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (left >= least_left * F.col("n_words"))).alias("kept"),
        left.alias("words_left"),
        F.coalesce("removed", F.array().cast("array<long>")).alias("removed"),
    ).withColumnRenamed("id", id_col)


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines whose hash is in ``removed``."""
    stays = lambda x: ~F.array_contains(removed, F.xxhash64(normal_line(x))) | (F.translate(x, SEPARATORS, "") == "")
    return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")
