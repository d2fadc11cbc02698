"""Exact Jaccard links between sets that share a key, with work that stays near-linear.

The operators on word shingles and on lines give, for each set, keys of which any two similar
sets share at least one. Sets under one key are compared all with all only in short lists; in a
long one they are first compared with a few centres, and then only inside the balls around
those.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearledger.llm.common import Tables, text_slices
from clearledger.llm.components import connected_components

SHORT_LIST = 64
BLOCK = 512
GROUP_ELEMENTS = 300_000
SIDE = 4  # blocks of a list that is compared all with all by blocks
_BITS = 1 << 26
_BUCKETS = 1 << 20
_COLUMNS = 8192
#: Rows of keys: in a shuffled parcel at most, in a bucket on average, held by a task at once.
PARCEL, BUCKET_KEYS, KEYS_AT_ONCE = 256, 1 << 16, 1 << 20
_ROW = np.dtype([("key", "<i8"), ("id", "<i8"), ("n", "<i4")])


@dataclass(frozen=True)
class Sets:
    """``texts`` turns rows of ``source`` into (id, text), one text for each id however often it occurs;
    ``elements`` makes the sorted distinct 64-bit hashes of each text's set."""

    source: DataFrame
    texts: Callable[[pa.RecordBatch], Iterator[tuple[int, str]]]
    elements: Callable[[list[str]], list[np.ndarray]]


def shared_keys(tables: Tables, keys: DataFrame) -> DataFrame:
    """Distinct (key, id, n) of the keys that more than one id has, with ``size``, their number.

    Most keys have one id. All are dealt by key once; both the aggregation that tells the others and the
    join that takes their rows read what was dealt. For that, both have to take the same columns, of
    which the aggregation uses ``n``, the size of an id's set, too: two ids whose sizes rule out the similarity make no list.
    """
    dealt = keys.repartition("key")
    several = dealt.groupBy("key").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("rows")
    )
    several = several.filter("lo != hi and (rows > 2 or 4 * least >= 3 * most)").select("key")
    matched = dealt.join(several.hint("shuffle_hash"), "key").select("key", "id", "n").distinct()
    kept = tables.put(matched, "keys")
    tables.release()
    return with_sizes(tables, kept)


Made = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _packed(keys: DataFrame, buckets: int, make: Made | None = None) -> DataFrame:
    """(bucket, rows): the (key, id, n) of ``keys``, one for each key of an array, in parcels of a bucket, ``PARCEL`` at most.
    ``make`` makes them of the rows of ``keys``, in the task that deals them."""
    narrow = np.uint16 if buckets <= 1 << 16 else np.uint64
    most = min(PARCEL * buckets, KEYS_AT_ONCE)

    def parcels(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        bucket = (rows["key"].view(np.uint64) % np.uint64(buckets)).astype(narrow)
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        starts = np.flatnonzero(place % PARCEL == 0)
        offsets = pa.py_buffer((np.append(starts, len(rows)) * _ROW.itemsize).astype(np.int32))
        made = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(rows)])
        return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int64)), made], ["bucket", "rows"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in make(batches) if make else batches:
            times = pa.compute.list_value_length(batch.column("key")).to_numpy()
            rows = np.empty(int(times.sum()), dtype=_ROW)
            rows["key"] = batch.column("key").flatten()
            for c in ("id", "n"):
                rows[c] = np.repeat(batch.column(c).to_numpy(), times)
            for start in range(0, len(rows), most):
                held.append(rows[start : start + most])
                count += len(held[-1])
                if count >= most:
                    yield parcels(held)
                    held, count = [], 0
        if count:
            yield parcels(held)

    return keys.mapInArrow(run, "bucket long, rows binary")


def _of_several(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows whose key more than one id has, sizes permitting, and how many their key has; up to three rows of every key."""
    order = np.argsort(rows["key"])
    key = rows["key"][order]
    same = np.concatenate([[False], key[1:] == key[:-1], [False]])
    again = same[1:] | same[:-1]
    lone, rows = rows[order[~again]], rows[order[again]]
    rows = rows[np.lexsort((rows["n"], rows["id"], rows["key"]))]
    rows = rows[np.concatenate([[True], rows[1:] != rows[:-1]])[: len(rows)]]
    if not len(rows):
        return rows, np.zeros(0, dtype=np.int64), lone
    first = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    count = np.diff(np.append(first, len(rows)))
    least, most = (f.reduceat(rows["n"], first).astype(np.int64) for f in (np.minimum, np.maximum))
    several = (count > 2) | ((count > 1) & (4 * least >= 3 * most))
    place = np.arange(len(rows)) - np.repeat(first, count)
    return rows[np.repeat(several, count)], np.repeat(count, count * several), np.concatenate([lone, rows[place < 3]])


def _several(batches: Iterable[pa.RecordBatch], sized: bool = False) -> Iterator[pa.RecordBatch]:
    """(key, id, n) of keys that more than one id has, from parcels sorted by bucket; if ``sized``, with ``size``, the number of the
    key's rows.

    Of a bucket, ``KEYS_AT_ONCE`` rows are held; beyond that, rows of keys that three have are given at once
    and three of each key are held on, so that a key that many ids have does not count. Such a key's rows may
    come again, and their size is null.
    """
    now, held, count, limit, early = None, [], 0, KEYS_AT_ONCE, None

    def given(rows: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(rows[c].astype(np.int64)) for c in ("key", "id", "n")]
        if sized:
            columns.append(pa.array(sizes, pa.int64(), mask=None if early is None else np.isin(rows["key"], early)))
        return pa.RecordBatch.from_arrays(columns, ["key", "id", "n", "size"][: len(columns)])

    for batch in batches:
        for bucket, rows in zip(batch.column("bucket").to_pylist(), batch.column("rows")):
            if bucket != now and count:
                yield given(*_of_several(np.concatenate(held))[:2])
                held, count, limit, early = [], 0, KEYS_AT_ONCE, None
            now = bucket
            held.append(np.frombuffer(rows.as_py(), dtype=_ROW))
            count += len(held[-1])
            if count >= limit:
                found, sizes, left = _of_several(np.concatenate(held))
                found, sizes = found[sizes > 2], sizes[sizes > 2]
                early = np.unique(found["key"]) if early is None else np.union1d(early, found["key"])
                yield given(found, sizes)
                held, count, limit = [left], len(left), max(KEYS_AT_ONCE, 2 * len(left))
    if count:
        yield given(*_of_several(np.concatenate(held))[:2])


def shared_keys_of(tables: Tables, keys: DataFrame, make: Made | None = None, total: int | None = None) -> DataFrame:
    """``shared_keys`` of rows (key, id, n) whose ``key`` is an array of an id's keys, or of those that ``make`` makes of
    the rows of ``keys``, about ``total`` keys in all; these are dealt as they are made and never stored.

    Rows are dealt once, by buckets of keys and in parcels, so that a shuffled row holds many; as many
    buckets are made as keep each small. A task has all rows of its buckets, so it also tells the sizes of lists; only
    keys that it had to give in parts are dealt once more. A null array holds no key.
    """
    if make is None:
        total = keys.agg(F.sum(F.size("key"))).first()[0] or 0
        keys = keys.filter("key is not null")
    dealt = _packed(keys, 1 + total // BUCKET_KEYS, make).repartition("bucket").sortWithinPartitions("bucket")
    lists = tables.put(dealt.mapInArrow(lambda batches: _several(batches, sized=True), "key long, id long, n long, size long"), "lists")
    tables.release()
    parts = lists.filter("size is null")
    if parts.isEmpty():
        return lists
    whole = with_sizes(tables, tables.put(parts.select("key", "id", "n").distinct(), "keys"))
    return lists.filter("size is not null").unionByName(whole)


def with_sizes(tables: Tables, kept: DataFrame) -> DataFrame:
    """Lists with ``size``, the number of their members; ``kept`` is dropped."""
    sizes = kept.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    lists = tables.put(kept.join(sizes, "key"), "lists")
    tables.drop(kept)
    return lists


def _pairs_by_list(lists: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) of ``pairs_in_lists``, once for each list that has both."""
    members = lists.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("m"))
    first = members.select("m", F.posexplode("m").alias("at", "x"))
    pairs = first.select("x", F.explode(F.slice("m", F.col("at") + 2, F.size("m"))).alias("y"))
    near = 4 * F.least("x.n", "y.n") >= 3 * F.greatest("x.n", "y.n")
    return pairs.filter(near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"))


def pairs_in_lists(lists: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, shared): pairs a < b of short lists whose sizes allow the similarity."""
    return _pairs_by_list(lists).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))


def needed_texts(tables: Tables, sets: Sets, ids: DataFrame) -> DataFrame:
    """(id, text) of ``ids``, which are hashes, read from the source in one pass.

    A bit map of fixed size, made of the ids in tasks, goes to all tasks and stops most other
    texts before the shuffle; the join then decides.
    """
    bit = F.pmod("id", F.lit(_BITS))
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits")
    )
    table = words.toArrow()
    bitmap = np.zeros(_BITS >> 6, dtype=np.uint64)
    bitmap[table.column("word").to_numpy().astype(np.int64)] = table.column("bits").to_numpy().view(np.uint64)
    shared = tables.spark.sparkContext.broadcast(bitmap)
    make = sets.texts

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for part in text_slices(batches):
            ids, texts = [], []
            made = list(make(part))
            at = np.array([i for i, _ in made], dtype=np.int64) % _BITS
            for k in np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)):
                i, text = made[k]
                if i not in seen:
                    ids.append(i)
                    texts.append(text)
                    seen.add(i)  # ids of texts that are needed only
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["id", "text"])

    found = sets.source.mapInArrow(run, "id long, text string").join(ids, "id")
    texts = tables.put(found.groupBy("id").agg(F.max("text").alias("text")), "texts")
    shared.destroy()
    return texts


def _shared(left: np.ndarray, right: np.ndarray) -> int:
    small, large = (left, right) if len(left) <= len(right) else (right, left)
    return int(np.count_nonzero(large.take(large.searchsorted(small), mode="clip") == small)) if len(large) else 0


def compare(tables: Tables, sets: Sets, texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, both, any, n): sizes of intersection and union of each pair (a, b, n_a, n_b), and of b.

    The pairs of one ``a`` are dealt over as many groups as bound the elements in each, so that
    a set with many partners does not fall to one task.
    """
    load = pairs.groupBy("a").agg(F.ceil((F.sum("n_b") + F.max("n_a")) / GROUP_ELEMENTS).alias("salts"))
    dealt = pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    dealt = tables.put(dealt, "dealt")
    partners = dealt.join(texts, dealt.b == texts.id).select("a", "salt", F.lit(1).alias("side"), "id", "text")
    owners = dealt.select("a", "salt").distinct().join(texts, F.col("a") == texts.id).select("a", "salt", F.lit(0).alias("side"), "id", "text")
    order = ["a", "salt", "side"]
    rows = owners.union(partners).repartition("a", "salt").sortWithinPartitions(*order)
    elements = sets.elements

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, np.zeros(0, dtype=np.uint64)
        for part in text_slices(batches, most_bytes=1 << 20):
            found = []
            made = elements(part.column("text").to_pylist())
            for a, salt, side, i, x in zip(*(part.column(c).to_pylist() for c in (*order, "id")), made):
                if side == 0:
                    group, own = (a, salt), x
                elif group == (a, salt):
                    both = _shared(own, x)
                    found.append((a, i, both, len(own) + len(x) - both, len(x)))
            columns = list(zip(*found)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "both", "any", "n"])

    told = tables.put(rows.mapInArrow(run, "a long, b long, both long, any long, n long"), "compared")
    tables.drop(dealt)
    return told


def linked(threshold: int = 75) -> Column:
    return 100 * F.col("both") >= threshold * F.col("any")


def _common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``left`` has in common with each of ``right``: products of
    0-1 matrices, some thousand elements at a time. An array on both sides is one set; elements of a
    single set, most of them by far, are left out first."""
    made = list({id(x): x for x in (*left, *right)}.values())
    place = {id(x): k for k, x in enumerate(made)}
    at_left, at_right = ([place[id(x)] for x in side] for side in (left, right))
    _, number, times = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *made]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(made)), [len(x) for x in made])
    several = times > 1
    inside = several[number]
    number, owner = (np.cumsum(several) - 1)[number[inside]], owner[inside]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    total = np.zeros((len(left), len(right)))
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, _COLUMNS):
        part = slice(*np.searchsorted(number, [first, first + _COLUMNS]))
        table = np.zeros((len(made), _COLUMNS), dtype=np.float32)
        table[owner[part], number[part] - first] = 1
        total += table[at_left] @ table[at_right].T
    with_itself = np.equal.outer(at_left, at_right)
    whole = np.array([len(x) for x in right], dtype=np.float64)
    return np.where(with_itself, whole, total).astype(np.int64)


def _blocks_linked(elements: Callable[[list[str]], list[np.ndarray]], group: pa.Table) -> pa.Table:
    """A spanning forest of the links across two blocks, between different components."""
    ids, comps = group.column("id").to_numpy(), group.column("component").to_numpy()
    left, right = (np.flatnonzero(np.array(group.column(c).to_pylist(), dtype=bool)) for c in ("left", "right"))
    made = elements(group.column("text").to_pylist())
    sizes = np.array([len(x) for x in made], dtype=np.int64)
    both = _common_counts([made[i] for i in left], [made[i] for i in right])
    near = 100 * both >= 75 * (sizes[left][:, None] + sizes[right][None, :] - both)
    near &= comps[left][:, None] != comps[right][None, :]
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while (p := parent.get(c, c)) != c:
            c = p
        return c

    found = []
    for i, j in zip(*np.nonzero(near)):
        c, d = root(int(comps[left[i]])), root(int(comps[right[j]]))
        if c != d:
            parent[max(c, d)] = min(c, d)
            found.append((int(ids[left[i]]), int(ids[right[j]])))
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)] or [pa.array([], pa.int64())] * 2, ["a", "b"])


def _prefix(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The elements of a set that two sets at 3/4 or more cannot both lack: the first
    n - ceil(3n/4) + 1 in the order of (count of the bucket, hash). Those in a bucket of count 1
    are in no other set and left out."""
    times = counts[(elements % np.uint64(_BUCKETS)).astype(np.int64)]
    first = np.lexsort((elements, times))[: len(elements) - (3 * len(elements) + 3) // 4 + 1]
    return elements[first[times[first] > 1]]


def _by_prefixes(tables: Tables, sets: Sets, texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(key, id, n): the elements in the prefix of each set of ``ids``, as keys.

    Two sets at 3/4 have at least ceil(3n/4) elements in common, n the size of the larger. So the
    first of those, in an order that holds for all sets, is in both prefixes, and no similar pair
    is lost. The order takes rare elements first, by counts in buckets of the hash, so that sets
    that only have a common passage rarely meet. A set has at most a quarter of its elements, and one, as keys.
    """
    elements = sets.elements
    chosen = tables.put(texts.join(ids, "id", "left_semi"), "prefix-texts")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_BUCKETS, dtype=np.int64)
        for part in text_slices(batches, most_bytes=1 << 20):
            found = np.concatenate(elements(part.column("text").to_pylist()))
            total += np.bincount((found % np.uint64(_BUCKETS)).astype(np.int64), minlength=_BUCKETS)
        for block in range(0, _BUCKETS, _COLUMNS):
            at = np.flatnonzero(total[block : block + _COLUMNS])
            if len(at):
                columns = [pa.array([block], pa.int64()), pa.array([at], pa.list_(pa.int64())), pa.array([total[block + at]], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "at", "n"])

    def add(group: pa.Table) -> pa.Table:
        """One block's counts, of one row a task."""
        at, n = (group.column(c).combine_chunks().flatten().to_numpy() for c in ("at", "n"))
        total = np.bincount(at, n, minlength=_COLUMNS).astype(np.int64)
        return pa.table({"block": [group.column("block")[0].as_py()], "n": pa.array([total], pa.list_(pa.int64()))})

    parts = chosen.mapInArrow(count, "block long, at array<long>, n array<long>")
    counts = np.zeros(_BUCKETS, dtype=np.int64)
    for row in parts.groupBy("block").applyInArrow(add, "block long, n array<long>").collect():
        counts[row.block : row.block + _COLUMNS] = row.n
    shared = tables.spark.sparkContext.broadcast(counts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, most_bytes=1 << 20):
            for i, own in zip(part.column("id").to_pylist(), elements(part.column("text").to_pylist())):
                keys = _prefix(own, shared.value).view(np.int64)
                columns = [keys, np.full(len(keys), i, dtype=np.int64), np.full(len(keys), len(own), dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "id", "n"])

    keys = tables.put(chosen.mapInArrow(run, "key long, id long, n long"), "prefixes")
    shared.destroy()
    tables.drop(chosen)
    return keys


def _balls(
    tables: Tables, sets: Sets, texts: DataFrame, long_lists: DataFrame
) -> tuple[DataFrame | None, list[DataFrame], list[DataFrame]]:
    """Compare long lists with centres until every member is near one.

    Gives (c, id, both, any, n, home) of all comparisons, lists that became short, and lists for ``_inside_balls``. A member is at
    home with the least centre of its list that it has a similarity of 1/2 or more with. A partner
    of it is then within 1/4 of that centre, by the triangle inequality of the Jaccard distance,
    so all its pairs of that list are found in that ball; the others stay in the list. Centres
    leave it, having met every member. One centre settles lists of near copies. The members that
    are left in long lists go to lists by the elements of their prefixes, which hold every similar
    pair of them; long ones of those are met by a centre, then, beyond ``SIDE`` blocks, by more each round. Of up to
    ``SIDE`` blocks, all members are at home in the list, as in a ball, so that it is compared by blocks: a text then goes to twice
    ``SIDE`` groups at most, fewer than it would meet centres, and no more rounds are needed.
    """
    balls, homes, short, blocks, centres, round_ = None, None, [], [], 1, 0
    while not long_lists.isEmpty():
        order = F.row_number().over(Window.partitionBy("key").orderBy("id"))
        if centres == 1:
            heads = long_lists.groupBy("key").agg(F.min("id").alias("c"), F.min_by("n", "id").alias("n_c"))
        else:
            ranked = long_lists.withColumn("k", order).filter(F.col("k") <= centres)
            heads = ranked.select("key", F.col("id").alias("c"), F.col("n").alias("n_c"))
        heads = tables.put(heads, "centres")
        met = tables.put(long_lists.join(heads, "key").filter("id != c").select("key", "c", "id", "n_c", "n"), "met")
        near = met.filter("4 * least(n, n_c) >= greatest(n, n_c)")
        ask = near.groupBy(F.col("c").alias("a"), F.col("id").alias("b")).agg(F.max("n_c").alias("n_a"), F.max("n").alias("n_b"))
        if balls is not None:
            ask = ask.join(balls.select(F.col("c").alias("a"), F.col("id").alias("b")), ["a", "b"], "left_anti")
        told = compare(tables, sets, texts, ask).select(F.col("a").alias("c"), F.col("b").alias("id"), "both", "any", "n")
        balls = told if balls is None else tables.put(balls.unionByName(told), "balls")
        inner = met.join(balls.filter("2 * both >= any").select("c", "id"), ["c", "id"])
        inner = tables.put(inner.groupBy("key", "id").agg(F.min("c").alias("c")), "inner")
        at_home = inner.select("c", "id").distinct()
        homes = at_home if homes is None else homes.union(at_home).distinct()
        done = inner.select("key", "id").union(heads.select("key", F.col("c").alias("id")))
        rest = long_lists.select("key", "id", "n").join(done, ["key", "id"], "left_anti")
        sizes = rest.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("load")).filter("size > 1")
        rest = tables.put(rest.join(sizes, "key"), "rest")
        short.append(rest.filter(f"size <= {SHORT_LIST}"))
        long_lists = rest.filter(f"size > {SHORT_LIST}")
        if round_ == 0 and not long_lists.isEmpty():
            keys = _by_prefixes(tables, sets, texts, long_lists.select("id").distinct())
            lists = shared_keys(tables, keys)
            tables.drop(keys)
            short.append(lists.filter(f"size <= {SHORT_LIST}"))
            long_lists = lists.filter(f"size > {SHORT_LIST}")
        else:
            few = (F.col("size") <= SIDE * BLOCK) & (F.col("load") <= SIDE * GROUP_ELEMENTS)
            one, yes = F.lit(1).cast("long"), F.lit(True)
            blocks.append(long_lists.filter(few).select(F.col("key").alias("c"), "id", one.alias("both"), one.alias("any"), "n", yes.alias("home")))
            long_lists = long_lists.filter(~few)
            centres *= 4
        round_ += 1
    if balls is not None:
        home = homes.select("c", "id").withColumn("home", F.lit(True))
        balls = balls.join(home, ["c", "id"], "left").withColumn("home", F.coalesce("home", F.lit(False)))
        balls = tables.put(balls, "balls")
    return balls, short, blocks


def _inside_balls(tables: Tables, sets: Sets, texts: DataFrame, balls: DataFrame, components: DataFrame) -> DataFrame:
    """Links between different components inside the balls, by blocks of members.

    A pair counts in the balls that one of the two is at home in, if it is of two components, so
    one of the two is outside the ball's largest one. That leaves two parts of a ball: members at
    home and outside it with all members, and members at home and inside it with the others that
    are outside. The sides of a part are cut into blocks of ``BLOCK`` sets and
    ``GROUP_ELEMENTS`` elements; each pair of blocks is a group of its own.
    """
    members = balls.filter("4 * both >= any").select("c", "id", "n", "home")
    members = members.join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    counts = members.groupBy("c", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("c").agg(F.max_by("component", F.struct("n", "component")).alias("major"), F.count("*").alias("kinds"))
    marked = members.join(largest.filter("kinds > 1"), "c").withColumn("minor", F.col("component") != F.col("major"))
    role = lambda part, left, when: F.struct(F.lit(part).alias("part"), F.lit(left).alias("left"), when.alias("holds"))
    home, minor = F.col("home"), F.col("minor")
    roles = F.array(role(0, True, home & minor), role(0, False, F.lit(True)), role(1, True, home & ~minor), role(1, False, ~home & minor))
    marked = marked.select("c", "id", "n", "component", F.explode(F.filter(roles, lambda x: x["holds"])).alias("role"))
    marked = marked.select("c", "id", "n", "component", "role.part", "role.left")
    left = F.col("left")
    blocks = lambda side: F.greatest(F.ceil(F.count_if(side) / BLOCK), F.ceil(F.sum(F.when(side, F.col("n")).otherwise(0)) / GROUP_ELEMENTS))
    sides = marked.groupBy("c", "part").agg(blocks(left).alias("rows"), blocks(~left).alias("columns")).filter("rows > 0 and columns > 0")
    dealt = marked.join(sides, ["c", "part"])
    own = F.pmod(F.xxhash64("id", "left"), F.when(left, F.col("rows")).otherwise(F.col("columns")))
    facing = F.when(left, F.col("columns")).otherwise(F.col("rows"))
    dealt = dealt.select("c", "part", "id", "component", "left", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), facing - 1)).alias("facing"))
    at = [F.when(left, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("own", "facing", "i"), ("facing", "own", "j"))]
    cells = dealt.select("c", "part", *at, "id", "component", "left")
    cells = cells.groupBy("c", "part", "i", "j", "id", "component").agg(F.max("left").alias("left"), F.max(~left).alias("right"))
    elements = sets.elements
    found = cells.join(texts, "id").groupBy("c", "part", "i", "j").applyInArrow(lambda group: _blocks_linked(elements, group), "a long, b long")
    return tables.put(found, "inside")


def components_of(tables: Tables, sets: Sets, pairs: DataFrame, long_lists: DataFrame) -> DataFrame:
    """(id, component) of all linked sets.

    Any two similar sets are a pair of ``pairs`` (a, b, n_a, n_b; n is the size of the set), or
    members of one of ``long_lists`` (key, id, n, size).

    Each set is first compared with the least of its candidates, and members of long lists with
    centres; what this joins need not be compared any more, so that a large group of near copies
    costs about one comparison a member. All other candidates are compared, none is given up.
    """
    short = tables.put(pairs, "pairs")
    ids = short.select(F.col("a").alias("id")).union(short.select("b")).union(long_lists.select("id")).distinct()
    texts = needed_texts(tables, sets, tables.put(ids, "ids"))
    tables.release()
    balls, more, blocks = _balls(tables, sets, texts, long_lists)
    if more:
        # Lists of two rounds may have one key; they stay apart.
        lists = [m.select(F.xxhash64("key", F.lit(k)).alias("key"), "id", "n") for k, m in enumerate(more)]
        short = tables.put(short.unionByName(_pairs_by_list(reduce(DataFrame.unionByName, lists))).distinct(), "pairs")
    first = short.groupBy("b").agg(F.min_by(F.struct("a", "n_a", "n_b"), "a").alias("p")).select("p.a", "b", "p.n_a", "p.n_b")
    told = compare(tables, sets, texts, tables.put(first, "first"))
    links = told.filter(linked()).select("a", "b")
    if balls is not None:
        links = links.union(balls.filter(linked()).select(F.col("c").alias("a"), F.col("id").alias("b")))
    tables.release()
    components = connected_components(tables, links)
    at = lambda c: components.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
    left = short.join(told.select("a", "b"), ["a", "b"], "left_anti").join(at("a"), "a", "left").join(at("b"), "b", "left")
    apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
    rest = compare(tables, sets, texts, tables.put(left.filter(apart).select("a", "b", "n_a", "n_b"), "left"))
    more_links = rest.filter(linked()).select("a", "b")
    if balls is not None:
        more_links = more_links.union(_inside_balls(tables, sets, texts, reduce(DataFrame.unionByName, [balls, *blocks]), components))
    stars = components.select(F.col("id").alias("a"), F.col("component").alias("b"))
    more_links = tables.put(stars.union(more_links), "links")
    tables.drop(texts, short)
    tables.release()
    return connected_components(tables, more_links)
