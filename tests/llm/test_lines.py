import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clearledger.llm import common, lines, linking, queries
from clearledger.llm.lines import MIN_CHARS, char_shingles, fuzzy_lines, many_char_shingles, normal, remove_repeated_lines, signatures


@pytest.fixture
def tables(spark):
    return common.Tables(spark, "test")


def grams(line):
    return {line[i : i + 8] for i in range(len(line) - 7)}


def long_lines(rows, least=MIN_CHARS):
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            x = " ".join(line.lower().split())
            if len(line) >= least and len(x) >= max(1, least):
                yield (i, k), x


def expected(rows, least=MIN_CHARS):
    places, parent = sorted(long_lines(rows, least)), {}
    sets = {x: grams(x) for _, x in places}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (_, x) in enumerate(places):
        for _, y in places[:k]:
            if x != y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                parent[root(x)] = root(y)
    first = {}
    for p, x in places:
        first.setdefault(root(x), p)
    return {p: first[root(x)] for p, x in places}


def corpus(rng):
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(8, 40))) for _ in range(40)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(base).split(" ")
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = rng.choice(words)
            text.append(rng.choice([" ".join, "  ".join])(line))
        rows.append((i, "\n".join([*text, "short", ""])))
    near = rng.choices(words, k=30)
    for i in range(linking.SHORT_LIST + 20):
        line = near.copy()
        line[rng.randrange(30)] = f"x{i}"
        rows.append((1000 + i, " ".join(line).upper() + "\nshort"))
    return rows


def test_lines_against_all_pairs(spark, docs):
    rows = corpus(random.Random(13))
    want, got = expected(rows), fuzzy_lines(spark, docs(rows)).collect()
    found = {(r.doc_id, r.line_no): (r.first_id, r.first_line_no) for r in got}
    assert len(found) == len(got) and found.keys() == want.keys()
    assert sum(found[p] != want[p] for p in want) <= 0.002 * len(want)
    assert all(r.kept == (found[r.doc_id, r.line_no] == (r.doc_id, r.line_no)) for r in got)


def test_removal(spark, docs):
    rows = [(1, "An opening line that is long enough to count here.\nshort"), (2, "An opening line that is long enough to count here!"), (3, "short"), (4, None), (5, "")]
    rows += [(6, "Some words that only this one document has in this whole corpus.\nAn opening line that is long  enough to count here.\nend")]
    got = {r.doc_id: r for r in remove_repeated_lines(spark, docs(rows)).collect()}
    assert {i: r.text for i, r in got.items()} == {**dict(rows[:1] + rows[2:5]), 6: "Some words that only this one document has in this whole corpus.\nend"}
    assert all(r.text is None or r.n_chars == len(r.text) for r in got.values())


def test_odd_rows(spark, odd, nothing):
    got = fuzzy_lines(spark, odd).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((str(r.doc_id), r.line_no) for r in got) == sorted((str(i), k) for (i, k), _ in long_lines(rows))
    assert fuzzy_lines(spark, nothing).count() == 0
    assert remove_repeated_lines(spark, nothing).count() == 0
    assert remove_repeated_lines(spark, odd).columns == odd.columns


def test_similar_lines_share_a_key():
    rng = random.Random(14)
    missed = tried = 0
    for size in (45, 90, 103, 108, 130, 135, 200, 400, 2000):
        for _ in range(40):
            line = "".join(rng.choices("abcdefgh ", k=size))
            other = list(line)
            other[rng.randrange(size)] = "z"
            if size > 150:
                other[rng.randrange(size)] = "y"
            pair = [normal(line), normal("".join(other))]
            a, b = map(grams, pair)
            if 100 * len(a & b) < 75 * len(a | b):
                continue
            keys = [set(), set()]
            for number, sizes, k in signatures(pair):
                for n, s, row in zip(number, sizes, k):
                    keys[n] |= set(row.tolist())
                    assert s == len(grams(pair[n]))
            tried += 1
            missed += not keys[0] & keys[1]
    assert tried > 200 and missed <= 0.005 * tried


def test_long_lists_lose_no_pair(spark, tables):
    rng = random.Random(15)
    passage = "".join(rng.choices("abcdefgh", k=60))
    texts = [(i, passage + "".join(rng.choices("ijklmnopq", k=90))) for i in range(3 * linking.SHORT_LIST)]
    texts += [(1000 + i, t[:-10] + "".join(rng.choices("xyz", k=10))) for i, t in texts[:60]]
    # One list of all, and keys of their own that partners do not share and that rank before it.
    keys = [(7, i, len(grams(t))) for i, t in texts] + [(10**6 * k + i, i, len(grams(t))) for i, t in texts for k in range(1, 40)]
    source = spark.createDataFrame(texts, "id long, text string")
    sets = linking.Sets(source, lambda part: zip(part.column("id").to_pylist(), part.column("text").to_pylist()), many_char_shingles)
    lists = linking.shared_keys(tables, spark.createDataFrame(keys, "key long, id long, n long"))
    pairs = linking.pairs_in_lists(lists.filter(F.col("size") <= linking.SHORT_LIST)).drop("shared")
    found = linking.components_of(tables, sets, pairs, lists.filter(F.col("size") > linking.SHORT_LIST))
    got = {r.id: r.component for r in found.collect() if r.id != r.component}
    assert got == {1000 + i: i for i in range(60)}


def test_shingles_are_sets_of_runs():
    for line in ("", "seven c", "eight ch", "aaaaaaaaaaaaaaaa", "漢字かな🙂漢字かな🙂", "a b" * 99):
        assert len(char_shingles(line)) == len(grams(line))
        assert char_shingles(line).dtype == np.uint64
    assert lines.line_id("x") != lines.line_id("y")


def test_every_line_with_a_word(spark, docs):
    rows = [(1, "MIT license.\n}\n\nOnly here, once"), (2, "MIT  License.\n \u00a0\n}"), (3, "}\nonly here, once!"), (4, "{\n\u3000")]
    got = {(r.doc_id, r.line_no): (r.first_id, r.first_line_no) for r in fuzzy_lines(spark, docs(rows), least_chars=1).collect()}
    same = {(i, k): (i, k) for i, k in ((1, 0), (1, 1), (1, 3), (4, 0))}
    assert got == {**same, (2, 0): (1, 0), (2, 2): (1, 1), (3, 0): (1, 1), (3, 1): (1, 3)}
    left = {r.doc_id: r.text for r in remove_repeated_lines(spark, docs(rows), least_chars=1).collect()}
    assert left == {1: rows[0][1], 4: rows[3][1]}


def test_the_query_and_the_pipeline_take_short_lines(spark, docs, tmp_path):
    df = docs([(1, "All rights reserved.\nyes"), (2, "All rights reserved.\nno"), (3, "yes")])
    df.write.parquet(f"{tmp_path}/in/documents.parquet")
    got = queries.op6_fuzzy_lines(spark, f"{tmp_path}/in").collect()
    assert {(r.doc_id, r.line_no) for r in got if not r.kept} == {(2, 0), (3, 0)} and len(got) == 5
    left = corpus_pipeline.line_dedup(spark, df, "").collect()
    assert {r.doc_id: r.text for r in left} == {1: "All rights reserved.\nyes", 2: "no"}


def all_lines(rng, changes):
    """Lines of any length with a word; copies with ``changes`` characters changed, and exact ones."""
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(150)]
    rows = []
    for i in range(300):
        text = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, *changes]) if len(line) > 240 * max(changes) else 0):
                line[rng.randrange(len(line))] = rng.choice("xyz")
            text.append("".join(line) if rng.random() < 0.7 else "".join(line).upper())
        rows.append((i, "\n".join([*text, rng.choice(["}", "", "  ", "All rights reserved."])])))
    return rows


def test_the_form_of_the_query_equals_all_pairs_for_close_lines(spark, docs, tmp_path):
    """Links at 0.85 and above: a changed character is in 8 of more than 230 shingles."""
    rows = all_lines(random.Random(17), [1])
    docs(rows).write.parquet(f"{tmp_path}/in/documents.parquet")
    got = {(r.doc_id, r.line_no): (r.first_id, r.first_line_no) for r in queries.op6_fuzzy_lines(spark, f"{tmp_path}/in").collect()}
    assert got == expected(rows, 1)


def test_recall_at_the_threshold():
    """Pairs between 0.75 and 0.80: the stated chance to share no key is 0.0014 at most."""
    rng, missed, tried = random.Random(18), 0, 0
    for _ in range(4000):
        line = rng.choices("abcdefghijklmnop ", k=rng.randint(60, 110))
        other = line.copy()
        other[rng.randrange(8, len(line) - 8)] = "z"
        pair = [normal("".join(line)), normal("".join(other))]
        a, b = map(grams, pair)
        if not 75 <= 100 * len(a & b) / max(1, len(a | b)) <= 80:
            continue
        keys = {}
        for number, _, k in signatures(pair):
            for n, row in zip(number, k):
                keys.setdefault(n, set()).update(row.tolist())
        tried += 1
        missed += not keys[0] & keys[1]
    assert tried > 300 and missed <= 0.0014 * tried + 3


def test_lines_beyond_the_room_for_numbers_have_keys():
    n = (1 << 20) + 5
    found = [(number, sizes) for number, sizes, _ in signatures([f"{i:08d}x" for i in range(n)])]
    assert sum(len(number) for number, _ in found) == n
    assert np.array_equal(np.sort(np.concatenate([number for number, _ in found])), np.arange(n))
    assert all((sizes == 2).all() for _, sizes in found)


def test_common_counts():
    rng = np.random.default_rng(19)
    sets = [np.unique(rng.integers(0, 30_000, size=k).astype(np.uint64)) for k in (0, 1, 500, 20_000, 20_000, 3)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets[2:]]
    assert linking._common_counts(sets[2:], sets).tolist() == want
    assert linking._common_counts([], []).shape == (0, 0)


def test_keys_are_dealt_once(spark, tables, monkeypatch):
    rows = [(1, 10, 8), (1, 11, 9), (1, 11, 9), (2, 10, 8), (3, 12, 100), (3, 13, 70), (4, 12, 100), (4, 13, 70), (4, 10, 8), (None, 10, 8), (None, 11, 9)]
    keys = spark.createDataFrame(rows, "key long, id long, n long").repartition(3, F.rand(5))
    plans, put = {}, tables.put

    def recorded(df, name):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        return put(df, name)

    monkeypatch.setattr(tables, "put", recorded)
    lists = {tuple(r) for r in linking.shared_keys(tables, keys).select("key", "id", "n", "size").collect()}
    assert lists == {(1, 10, 8, 2), (1, 11, 9, 2), (4, 12, 100, 3), (4, 13, 70, 3), (4, 10, 8, 3)}
    assert list(plans) == ["keys", "lists"]
    assert plans["keys"].count("REPARTITION_BY_COL") == 1 + plans["keys"].count("ReusedExchange") == 2


def test_prefixes_leave_out_what_no_other_set_has():
    counts = np.ones(linking._BUCKETS, dtype=np.int64)
    counts[5:12] = 3
    own = np.arange(3, 13, dtype=np.uint64)  # 3 of 10 are the prefix: 3, 4 and 12 are in no other set
    assert linking._prefix(own, counts).tolist() == []
    counts[4] = 2
    assert linking._prefix(own, counts).tolist() == [4]
    counts[:] = 2
    assert linking._prefix(own, counts).tolist() == [3, 4, 5]


def test_arrays_of_keys_are_dealt_in_parcels(spark, tables, monkeypatch):
    rows = [([1, 2], 10, 8), ([1], 11, 9), ([1], 11, 9), ([3, 4], 12, 100), ([3, 4], 13, 70), ([4], 10, 8), (None, 10, 8), ([], 11, 9)]
    keys = spark.createDataFrame(rows, "key array<long>, id long, n long").repartition(3, F.rand(5))
    told = lambda lists: {tuple(r) for r in lists.select("key", "id", "n", "size").collect()}
    assert told(linking.shared_keys_of(tables, keys)) == {(1, 10, 8, 2), (1, 11, 9, 2), (4, 12, 100, 3), (4, 13, 70, 3), (4, 10, 8, 3)}
    assert told(linking.shared_keys_of(tables, keys.limit(0))) == set()
    rng = random.Random(3)
    flat = [(k * 2**40 - 2**62, rng.randrange(400)) for k in (rng.choice((7, rng.randrange(900))) for _ in range(4000))]
    flat = [(k, i, 90 + i % 7) for k, i in flat]
    arrays = spark.createDataFrame([([k, k + 1], i, n) for k, i, n in flat], "key array<long>, id long, n long")
    both = spark.createDataFrame([(k + d, i, n) for k, i, n in flat for d in (0, 1)], "key long, id long, n long")
    want = told(linking.shared_keys(tables, both))
    assert len(want) > 1000 and told(linking.shared_keys_of(tables, arrays)) == want
    batches = list(linking._packed(arrays, 5).toArrow().sort_by("bucket").to_batches(max_chunksize=3))
    assert all(len(x.as_py()) <= linking.PARCEL * linking._ROW.itemsize for b in batches for x in b.column("rows"))
    monkeypatch.setattr(linking, "KEYS_AT_ONCE", 50)  # far less than a key has
    held = [r for b in linking._several(batches) for r in zip(*b.to_pydict().values())]
    assert set(held) == {r[:3] for r in want}


def test_texts_with_normal_spaces_are_lowered_at_once(monkeypatch):
    texts = ["a b\nΑΣ\nΣ c\n\nİx", "A  b\n c", "a\tb", " a", "a ", "x \ny", "x y", "x y\nz", "a\r\nb", "a\x1cb", "ΟΔΟΣ\nΣΟΦΟΣ a.\nß", "\n\n", "", None, "İ" * 3 + "\nab"]
    got = [list(lines._lines_of(t, least)) for t in texts for least in (1, 4)]
    assert sum(lines._plain(t) for t in texts if t) == 4
    monkeypatch.setattr(lines, "_plain", lambda text: False)
    assert got == [list(lines._lines_of(t, least)) for t in texts for least in (1, 4)]


def test_lists_are_sized_where_they_are_made(spark, tables, monkeypatch):
    rng = random.Random(4)
    flat = [(k, rng.randrange(300), 90) for k in (rng.choice((7, rng.randrange(900))) for _ in range(2000))]
    members = {k: {i for x, i, _ in flat if x == k} for k, _, _ in flat}
    want = {(k, i, 90, len(ids)) for k, ids in members.items() if len(ids) > 1 for i in ids}
    arrays = spark.createDataFrame([([k], i, n) for k, i, n in flat], "key array<long>, id long, n long")
    names, put = [], tables.put
    monkeypatch.setattr(tables, "put", lambda df, name: names.append(name) or put(df, name))
    got = [tuple(r) for r in linking.shared_keys_of(tables, arrays).select("key", "id", "n", "size").collect()]
    assert len(got) == len(want) and set(got) == want
    assert names == ["lists"]
    batches = linking._packed(arrays, 3).toArrow().sort_by("bucket").to_batches(max_chunksize=3)
    monkeypatch.setattr(linking, "KEYS_AT_ONCE", 60)  # less than the frequent key has
    held = [r for b in linking._several(batches, sized=True) for r in zip(*b.to_pydict().values())]
    parts = {r[0] for r in held if r[3] is None}
    assert 7 in parts and len(parts) < len(members) / 2
    assert {r for r in held if r[0] not in parts} == {r for r in want if r[0] not in parts}
    assert {r[:3] for r in held if r[0] in parts} == {r[:3] for r in want if r[0] in parts} and all(r[3] is None for r in held if r[0] in parts)


def test_keys_of_lines_are_dealt_as_they_are_made(spark, tables, docs, monkeypatch):
    texts = ["the very first line of this text\nshort\n" + "a line that several texts have in common\n" * 2] * 3 + ["x", None, ""]
    names, put = [], tables.put
    stored = []
    monkeypatch.setattr(tables, "put", lambda df, name: names.append(name) or stored.extend(df.dtypes) or put(df, name))
    rows = lines.fuzzy_lines(spark, docs(enumerate(texts)).repartition(3, "doc_id"), tables=tables, least_chars=1)
    assert rows.count() == 3 * 4 + 1 and rows.filter("kept").count() == 4
    assert names[:2] == ["places", "lists"] and not [kind for _, kind in stored if kind.startswith("array")]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    made = [pa.Table.from_batches([b]) for b in lines._line_keys([batch, batch], 1)]
    assert sum(t.num_rows for t in made) == 2  # once a task, none for lines without a shingle
    assert all(len(k) == lines.BANDS for t in made for k in t.column("key").to_pylist())
    want = {lines.line_id(x): len(lines.char_shingles(x)) for x in texts[0].split("\n") if len(x) >= lines.WIDTH}
    assert {i: n for t in made for i, n in zip(t.column("id").to_pylist(), t.column("n").to_pylist())} == want
