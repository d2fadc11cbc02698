import math
import random
import re
from collections import Counter

import pytest

from clearledger.llm import ranking
from clearledger.llm.queries import ORACLE, REGISTRY
from tests.compare import differences, oracle_connection

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=10):
    found = [(i, TERMS.findall((t or "").translate(LOWER))) for i, t in docs]
    n_docs, length = sum(bool(ws) for _, ws in found), sum(len(ws) for _, ws in found)
    df = Counter(w for _, ws in found for w in set(ws))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERMS.findall((t or "").translate(LOWER)))
    out = []
    for item, ws in asked.items():
        scores = []
        for i, own in found:
            tf, m = Counter(own), 10 + 90 * len(own) * n_docs // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * tf[w] // (1000 * tf[w] + 8 * m)) for w in ws if tf[w])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    items = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, score int, rank string")
    docs = docs if hasattr(docs, "columns") else spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, item_id string")
    return sorted((tuple(r) for r in ranking.rank(spark, docs.repartition(3), items, **options).collect()), key=str)


def texts(seed, n):
    """Few words, so that many bags are equal, with copies and differences outside the vocabulary."""
    pick = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "漢字", "x1", "other", "more"]
    made = [" ".join(pick.choices(words, k=pick.randint(0, 9))) for _ in range(n)]
    return made + made[: n // 3] * 2 + [made[0]] * n


@pytest.mark.parametrize("block", [500_000, 3])
def test_ranks_equal_brute_force(spark, block):
    docs = [(i * 7 % 1009, t) for i, t in enumerate(texts(5, 120))]
    items = [(1, "alpha gamma"), (2, "DÉLTA beta; beta"), (3, "x1-漢字"), (4, "unheard of"), (5, "alpha " * 5 + "x1 délta other")]
    assert got(spark, docs, items, block_entries=block) == brute(docs, items)


def test_small_cells_and_top(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PIECE", 5)
    docs = [(i, t) for i, t in enumerate(texts(6, 60))]
    items = [(1, "alpha gamma"), (2, "beta x1 délta")]
    assert list(w for some in ranking.terms("one two-three fourth") for w in some) == [b"one", b"two", b"three", b"fourth"]
    assert got(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_odd_rows(spark, odd):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "word id"), (1, "here"), (2, None), (3, ""), (None, "ünïcödé 漢字 a"), (4, "x" * 50_000), (5, "--- $$$ 123")]
    assert got(spark, odd, items) == brute(docs, items)


def test_empty_tables(spark, nothing, odd):
    assert got(spark, nothing, [(1, "word")]) == []
    assert got(spark, odd, []) == []


def test_query_matches_its_sql(spark, sf_dir):
    name = "op11_bag_deduplicated_search"
    with oracle_connection(sf_dir) as con:
        assert differences(REGISTRY[name](spark, sf_dir), con, ORACLE[name]) == []
