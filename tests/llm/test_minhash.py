import random
import re

import numpy as np
import pytest

from clearledger.llm import common, linking
from clearledger.llm.minhash import KEPT, LEAST_OF_UNION, near_duplicates
from clearledger.llm.shingles import text_shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(pairs):
    """Components of all pairs at 0.75 or more; rows of one id are one document."""
    sets = [(i, shingle_set(t)) for i, t in pairs if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def check(spark, df, pairs):
    want = expected(pairs)
    rows = near_duplicates(spark, df).collect()
    assert len(rows) == len(pairs)
    sizes = sorted((str(i), len(shingle_set(t))) for i, t in pairs)
    assert sorted((str(r.doc_id), r.n_shingles) for r in rows) == sizes
    for r in rows:
        assert r.component_id == want.get(r.doc_id), r
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    return want


def changed(words, rng, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in words)


def test_groups_chains_and_shared_passages(spark, docs):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    pairs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for i in range(60)]
    base = rng.choices(vocabulary, k=120)
    # A large group of near copies, around the threshold: links of some only lead through others.
    pairs += [(1000 + i, changed(base, rng, 0.02)) for i in range(linking.SHORT_LIST * 2)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    # Documents that a common passage dominates, without being copies of each other.
    pairs += [(2000 + i, " ".join([passage, *rng.choices(vocabulary, k=rng.randint(5, 60))])) for i in range(linking.SHORT_LIST * 2)]
    pairs += [(3000 + i, " ".join(base)) for i in range(40)] + [(3100, " ".join(base).upper())]
    chain = rng.choices(vocabulary, k=200)
    pairs += [(4000 + k, " ".join(chain[2 * k : 2 * k + 60])) for k in range(30)]
    want = check(spark, docs(pairs), pairs)
    groups = [sum(v == c for v in want.values()) for c in set(want.values())]
    assert max(groups) > linking.SHORT_LIST and len(groups) > 100


def test_many_short_documents(spark, docs):
    rng = random.Random(9)
    pairs = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 12)))) for i in range(400)]
    check(spark, docs(pairs), pairs)


def test_odd_rows(spark, odd, nothing):
    check(spark, odd, [(r.doc_id, r.text) for r in odd.collect()])
    assert near_duplicates(spark, nothing).count() == 0


def test_an_id_with_two_texts_joins_their_components(spark, docs):
    rng = random.Random(10)
    one, two = (" ".join(f"{c}{rng.randrange(999)}" for _ in range(40)) for c in "xy")
    rows = near_duplicates(spark, docs([(1, one), (5, one), (5, two), (9, two)])).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (5, 1), (9, 1)}


def test_an_id_with_two_texts_keeps_links_of_near_copies(spark, docs):
    rng = random.Random(11)
    one, two = ([f"{c}{rng.randrange(999)}" for _ in range(60)] for c in "xy")
    near = lambda words: " ".join([*words[:-1], "else"])
    pairs = [(5, " ".join(one)), (5, " ".join(two)), (7, near(one)), (9, near(two)), (8, "a text of its own with some words")]
    want = check(spark, docs(pairs), pairs)
    assert want == {5: 5, 7: 5, 9: 5, 8: 8}


def test_contained_sets_with_common_parts(spark, docs):
    """One set is inside the other, and most of what they share is common to many documents."""
    rng = random.Random(12)
    passages = [[f"p{k}x{i}" for i in range(90)] for k in range(3)]
    pairs = [(i, " ".join([*passages[i % 3], *(f"own{i}x{j}" for j in range(60))])) for i in range(3 * (linking.SHORT_LIST + 10))]
    for i in range(60):
        own = [f"in{i}x{j}" for j in range(rng.randint(10, 25))]
        more = [f"more{i}x{j}" for j in range(rng.randint(20, 40))]
        pairs += [(2000 + 2 * i, " ".join([*passages[i % 3], *own])), (2001 + 2 * i, " ".join([*passages[i % 3], *own, *more]))]
    want = check(spark, docs(pairs), pairs)
    assert sum(want[2001 + 2 * i] != 2001 + 2 * i for i in range(60)) > 30


def test_lists_that_centres_leave_are_compared_by_blocks(spark, docs, monkeypatch):
    """Documents of three of twelve passages share keys with many others, but are not near their centres."""
    rng = random.Random(14)
    monkeypatch.setattr(linking, "SHORT_LIST", 3)
    passages = [[f"p{k}x{i}" for i in range(30)] for k in range(12)]
    pairs = []
    for i in range(80):
        words = [w for k in rng.sample(range(12), 3) for w in passages[k]]
        pairs.append((i, " ".join(words)))
        if i % 4 == 0:
            pairs.append((1000 + i, " ".join([*words, "more"])))
    names, put = [], common.Tables.put
    monkeypatch.setattr(common.Tables, "put", lambda self, df, name: names.append(name) or put(self, df, name))
    want = check(spark, docs(pairs), pairs)
    assert all(want[1000 + i] == want[i] for i in range(0, 80, 4))
    assert 1 <= names.count("centres") <= 2


def test_sketches_of_unions():
    rng = np.random.default_rng(13)
    low = 0
    for _ in range(3000):
        both, more = rng.integers(0, 2**62, 300), rng.integers(0, 2**62, 100)
        a, b = np.sort(np.append(both, more[:50]))[:KEPT], np.sort(np.append(both, more[50:]))[:KEPT]
        union = np.union1d(a, b)[:KEPT]
        low = max(low, KEPT - len(np.intersect1d(union, np.intersect1d(a, b))))
    assert KEPT - low > LEAST_OF_UNION


@pytest.mark.parametrize("text", ["", "a", "A b\tc", "one two three four five six", "x " * 50, "É é ǅ " * 9])
def test_hashed_sets_have_the_size_of_the_sets(text):
    assert len(text_shingles(text)) == len(shingle_set(text))
