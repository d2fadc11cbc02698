import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from clearledger.llm import trie
from clearledger.llm.common import Tables
from clearledger.llm.queries import ORACLE, REGISTRY
from tests.compare import differences, oracle_connection

SCHEMA = "conv_id long, turn long, role string, text string, kept string, depth int"


def brute(rows):
    """Nodes by every prefix of every rebuilt conversation."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - int(abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, ms in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(ms) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(made[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(ms), len(p), parent, len(ms), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, rows, tmp_path, **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    tables = Tables(spark, "trie")
    return sorted((tuple(r) for r in trie.prefix_trie(spark, trie.rebuilt(spark, df, tables), tables=tables, **sizes).collect()), key=str)


def random_rows(seed, n_convs, n_texts, longest, copies):
    """Few different turns, so that prefixes are shared at every depth, and many copies of some."""
    pick = random.Random(seed)
    shapes = [[pick.choice("ab" if d < 4 else "abcde"[:n_texts]) * (d % 3 + 1) for d in range(pick.randint(1, longest))] for _ in range(n_convs)]
    for k in range(copies):
        shapes.append(list(shapes[0]))
    rows = []
    for i, shape in enumerate(shapes):
        start = pick.choice([0, 5])
        rows += [(i, start + d, pick.choice(["user"]), t) for d, t in enumerate(shape)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"segment": 3, "forest_turns": 4}), (3, {"segment": 2, "forest_turns": 30}), (4, {"segment": 5, "forest_turns": 1})])
def test_nodes_are_those_of_every_prefix(spark, tmp_path, seed, sizes):
    rows = random_rows(seed, 40, 3, 14, 25)
    assert nodes(spark, rows, tmp_path, **sizes) == brute(rows)


def test_one_conversation_may_span_segments_and_tasks(spark, tmp_path):
    long_ = [(0, i, "user", f"t{i}") for i in range(300)]
    rows = long_ + [(5, i, "user", f"t{i}") for i in range(120)] + [(10, i, "user", f"t{i}" if i < 200 else "else") for i in range(230)]
    assert nodes(spark, rows, tmp_path, segment=16, forest_turns=40) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, 1, "user", "no conversation"), (1, 0, "user", "shorter than its cut"), (7, None, None, None), (7, 0, "user", ""), (7, 0, "assistant", "tie"),
        (7, 0, "assistant", "tie"), (7, 0, "assistant", "another"), (-3, 2, "user", "é" * 50_000), (-5, 0, "user", "b"), (-5, 1, "user", "c"),
    ]
    assert nodes(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert nodes(spark, [], tmp_path) == []


def test_query_matches_its_sql(spark, sf_dir):
    name = "op12_conversation_prefix_trie"
    with oracle_connection(sf_dir) as con:
        assert differences(REGISTRY[name](spark, sf_dir), con, ORACLE[name]) == []


def test_short_conversations_write_few_tables(spark, tmp_path, monkeypatch):
    rows = [(c, i, "user", f"t{i * (c % 3)}") for c in (-8, -5, -4, 0, 1, 4, 5, 9, 12, 15) for i in range(40 if c in (0, 5) else c % 7)]
    names, put = [], Tables.put
    monkeypatch.setattr(Tables, "put", lambda self, df, name: names.append(name) or put(self, df, name))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")  # conversations 0 and 5 lie in several ranges
    try:
        assert nodes(spark, rows, tmp_path) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(names) <= 10
