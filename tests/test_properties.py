"""Properties over generated texts: shape tests never change a parse, cleaning is stable."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearledger.functions import codes, parsing, text
from clearledger.operators import defects

BATCHES = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
WORDS = st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12), max_size=200)


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "c string")


def date_like(seed, n):
    """Dates in many formats, most of them with a character changed, added or removed."""
    rng = random.Random(seed)
    shapes = [
        "{y}-{m}-{d} {H}:{M}:{S}", "{m}/{d}/{y} {H}:{M}", "{d}-{m}-{y} {H}:{M}:{S}", "{y}/{m}/{d}",
        "{y}-{m}-{d}T{H}:{M}:{S}.{f}Z", "{y}-{m}-{d}", "{m}/{d}/{y}", "{d}/{m}/{y}", "{d}-{m}-{y}",
    ]
    out = []
    for _ in range(n):
        s = rng.choice(shapes).format(
            y=rng.choice(["2016", "0099", "12016", "+12016", "-2016", "+2016", "216", "+294246", "+294199", "+100000", "-290307", "-290299", "-99999", "+012016", "-000016", "+0000294246", "0000", "-0000", "+00000"]) if rng.random() < 0.2 else "2016",
            m=f"{rng.randint(0, 14):02d}", d=f"{rng.randint(0, 32):02d}", H=f"{rng.randint(0, 25):02d}",
            M=f"{rng.randint(0, 61):02d}", S=f"{rng.randint(0, 61):02d}", f=str(rng.randint(0, 12000)),
        )
        change, at = rng.random(), rng.randrange(len(s))
        if change < 0.2:
            s = s[:at] + rng.choice(" 0129-/:.TtzZ٣\n") + s[at + 1 :]
        elif change < 0.3:
            s = s[:at] + rng.choice(" 0129-/:") + s[at:]
        elif change < 0.4:
            s = s[:at] + s[at + 1 :]
        elif change < 0.5:
            s = s.lower()
        out.append(s)
    return out


def too_far(text):
    """Whether Spark's own parse may fail on a year of the text."""
    return any(len(y) > 7 or not parsing.FIRST_YEAR <= int(y) <= parsing.LAST_YEAR for y in re.findall("[+-]?[0-9]{6,}", text))


def changed_by_shape(spark, texts, guarded, plain):
    texts = [t for t in texts if not too_far(t)]
    df = frame(spark, texts).withColumns({"a": guarded(F.col("c")), "b": plain(F.col("c"))})
    return df.filter(~F.col("a").eqNullSafe(F.col("b"))).select("c", F.col("a").cast("string"), F.col("b").cast("string")).collect()


def plain_timestamp(c):
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in parsing.TIMESTAMP_FORMATS])


def plain_date(c):
    return F.coalesce(*[F.try_to_date(c, f) for f in parsing.DATE_FORMATS])


def test_shapes_do_not_change_parsing(spark):
    texts = date_like(7, 20_000)
    assert changed_by_shape(spark, texts, parsing.parse_timestamp, plain_timestamp) == []
    assert changed_by_shape(spark, texts, parsing.parse_date, plain_date) == []
    readable = frame(spark, texts).filter(parsing.parse_timestamp(F.col("c")).isNotNull()).count()
    assert 4_000 < readable < 19_000


@BATCHES
@given(texts=WORDS)
def test_shapes_do_not_change_parsing_of_any_text(spark, texts):
    assert changed_by_shape(spark, texts, parsing.parse_timestamp, plain_timestamp) == []


@BATCHES
@given(texts=WORDS)
def test_cleaning_twice_is_cleaning_once(spark, texts):
    for clean in (text.trimmed, text.normalize_email, text.normalize_currency, codes.normalize_country):
        df = frame(spark, texts).select(clean(F.col("c")).alias("c"))
        assert df.filter(clean(F.col("c")) != F.col("c")).count() == 0


@pytest.mark.parametrize("fmt", parsing.TIMESTAMP_FORMATS[:5])
def test_written_times_read_back(spark, fmt):
    unit = {"yyyy/MM/dd": "day", "MM/dd/yyyy HH:mm": "minute"}.get(fmt, "second")
    df = spark.range(3000).select(F.timestamp_seconds(F.col("id") * 600_011).alias("t"))
    back = parsing.parse_timestamp(defects.vary_format(F.col("t"), F.lit(1), [fmt]))
    assert df.filter(~back.eqNullSafe(F.date_trunc(unit, "t"))).count() == 0


def test_padding_and_spelling_are_undone(spark):
    k = F.col("id")
    named = F.concat(F.lit("Van Den Berg "), k.cast("string"))
    df = spark.range(3000).select("id", named.alias("name"))
    messy = defects.pad_spaces(defects.vary_case(F.col("name"), k, 1), k, 2)
    assert df.filter(text.proper_case(messy) != F.col("name")).count() == 0
    for code, spellings in codes.HOLDING_TYPES.items():
        spelled = defects.pad_spaces(defects.vary_case(defects.vary_spelling(k, spellings, 3), k, 4), k, 5)
        assert df.filter(codes.resolve_holding_type(spelled) != code).count() == 0
