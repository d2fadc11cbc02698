import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from clearledger.llm import queries
from clearledger.llm.quality import judge, without_lines
from tests.compare import differences, oracle_connection

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def normal(line):
    return re.sub(r"[ \t-\r]+", " ", re.sub(r"[0-9]", "0", line.lower())).strip(" ")


def expected(rows, limit=10):
    on = defaultdict(set)
    for k, (_, text, host) in enumerate(rows):
        for line in (text or "").split("\n"):
            on[host or "", normal(line)].add(k)
    found = []
    for i, text, host in rows:
        lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x) and len(on[host or "", normal(x)]) > limit)
        b = base(text)
        found.append((str(i), *b, not b[5] and 2 * (b[0] - lost) >= b[0], b[0] - lost))
    return sorted(found)


def got(spark, df):
    rows = judge(spark, df).collect()
    return sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.words_left) for r in rows)


def test_against_plain_python(spark, docs):
    rng = random.Random(15)
    rows = []
    for i in range(150):
        lines = [" ".join(rng.choices(["a", "the", "Éa", "x#", "1|2", "long"], k=rng.randint(0, 12))) for _ in range(rng.randint(0, 12))]
        if i % 3 == 0:
            lines += ["A footer that many documents of this host have, in 2024 words and with a few more words."] * 3
        rows.append((i, rng.choice(["\n", "\r\n", "\n\n"]).join(lines), None if i % 7 == 0 else f"host{i % 2}"))
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, kept string")
    assert got(spark, df) == expected(rows)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    assert got(spark, odd) == expected(rows)
    assert judge(spark, nothing).count() == 0


def test_plan_has_no_python(spark, sf_dir):
    plan = queries.op7_line_frequency_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_removed_lines_leave_the_text(spark, docs):
    rows = [(i, f"Own words number {'x' * i} " + "a b c " * 20 + "\nThe same footer on each page\n\nend") for i in range(12)]
    df = docs(rows).join(judge(spark, docs(rows)).select("doc_id", "removed"), "doc_id")
    texts = [r.t for r in df.select(without_lines(df.text, df.removed).alias("t")).collect()]
    assert all("footer" not in t and "Own words" in t for t in texts)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, sf_dir, name):
    with oracle_connection(sf_dir) as con:
        assert isinstance(con, duckdb.DuckDBPyConnection)
        assert differences(queries.REGISTRY[name](spark, sf_dir), con, queries.ORACLE[name]) == []
