"""Near-duplicate vectors: sign hashing in several tables, exact cosine, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearledger.llm.common import Tables
from clearledger.llm.components import connected_components

LEAST_COSINE = 0.93
MISS = 1e-6
BUCKET = 1024
BLOCK = 2048
CHUNK = 256
_CELL = ["key", "at", "i", "j", "side", "cls"]


def plan(largest: int, cosine: float = LEAST_COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a hash, and tables.

    So many bits that the largest label has about ``BUCKET`` vectors a bucket, and so many tables
    that a pair at ``cosine`` shares no bucket with a chance of ``miss`` at most.
    """
    bits = max(1, math.ceil(math.log2(max(2, largest) / BUCKET))) if largest > BUCKET else 1
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - same))


def sketch_plan(bits: int, cosine: float = LEAST_COSINE, miss: float = MISS) -> tuple[int, int]:
    """Hashes whose bits fill one word of the two-word sketch, and the most sketch bits in which
    vectors at ``cosine`` differ, but for a chance of ``miss``."""
    per = 64 // bits
    n, differs = 2 * per * bits, math.acos(cosine) / math.pi
    beyond, most = 0.0, n
    while most > 0:
        beyond += math.comb(n, most) * differs**most * (1 - differs) ** (n - most)
        if beyond > miss:
            break
        most -= 1
    return per, most


def _vectors(rows: DataFrame, kind: str) -> DataFrame:
    """(id, label, dim, d1, d2, vector) of rows that can link: ``vector`` as bytes of ``kind``,
    d1 and d2 are its digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "label", "dim", "d1", "d2", "vector"]
        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # no negative zeros
            values[flat.is_null().to_numpy(zero_copy_only=False)] = np.nan
            dims = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.cumsum(dims) - dims
            known = batch.column("id").is_valid().to_numpy(zero_copy_only=False) & batch.column("label").is_valid().to_numpy(zero_copy_only=False)
            for d in np.unique(dims[known & (dims > 0)]).tolist():
                at = np.flatnonzero(known & (dims == d))
                x = values[starts[at][:, None] + np.arange(d)]
                good = np.isfinite(x).all(axis=1) & x.any(axis=1)
                at, data = at[good], [v.tobytes() for v in x[good]]
                own = batch.take(pa.array(at))
                digests = [hashlib.blake2b(v, digest_size=16).digest() for v in data]
                d1, d2 = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2).T.copy()
                columns = [own.column("id"), own.column("label"), pa.array(np.full(len(at), d)), pa.array(d1), pa.array(d2), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, "id long, label string, dim long, d1 long, d2 long, vector binary")


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1).astype("<f8")
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signed(classes: DataFrame, kind: str, bits: int, tables: int, per: int) -> DataFrame:
    """``classes`` with ``codes``, one a table, and the sketch: two words that hold the first codes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        hashes = max(tables, 2 * per)
        power = 1 << np.arange(bits, dtype=np.int64)
        place = np.arange(per, dtype=np.uint64) * np.uint64(bits)
        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK):
                part = batch.slice(k, CHUNK)
                dims = np.array(part.column("dim").to_pylist())
                for d in np.unique(dims):
                    if d not in planes:
                        planes[d] = np.random.default_rng(int(d)).standard_normal((int(d), hashes * bits))
                    own = part.filter(pa.array(dims == d))
                    signs = _unit(own.column("vector").to_pylist(), kind) @ planes[d] > 0
                    codes = (signs.reshape(-1, hashes, bits) * power).sum(axis=2)
                    words = [(codes[:, i : i + per].astype(np.uint64) << place).sum(axis=1, dtype=np.uint64).view(np.int64) for i in (0, per)]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * tables), pa.array(codes[:, :tables].reshape(-1)))
                    columns = [own.column(c) for c in names] + [lists, *map(pa.array, words)]
                    yield pa.RecordBatch.from_arrays(columns, [*names, "codes", "hi", "lo"])

    names = ["cls", "label", "dim", "copies", "vector"]
    return classes.select(*names).mapInArrow(
        run, "cls long, label string, dim long, copies long, vector binary, codes array<long>, hi long, lo long"
    )


def _sides(group: pa.Table) -> tuple[pa.Table, pa.Table, bool]:
    """The two blocks of a cell, and whether they are one."""
    alone = group.column("i")[0].as_py() == group.column("j")[0].as_py()
    if alone:
        return group, group, True
    side = group.column("side").to_numpy()
    return group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1)), False


def _near(bits: int, per: int, most: int, group: pa.Table) -> pa.Table:
    """Rows of a cell that may have a link there: some other row's sketch is near enough, and no
    earlier hash in the sketches is equal."""
    left, right, alone = _sides(group)
    words = [[side.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("hi", "lo")] for side in (left, right)]
    marks = np.zeros(left.num_rows, dtype=bool), np.zeros(right.num_rows, dtype=bool)
    mask = np.uint64((1 << bits) - 1)
    at = group.column("at")[0].as_py()
    for k in range(0, left.num_rows, CHUNK):
        differ = [words[0][w][k : k + CHUNK, None] ^ words[1][w][None, :] for w in (0, 1)]
        n_bits = np.bitwise_count(differ[0]) + np.bitwise_count(differ[1])
        i, j = np.nonzero(n_bits <= most)
        if alone:
            i, j = i[i + k < j], j[i + k < j]
        for t in range(min(at, 2 * per)):
            new = (differ[t // per][i, j] >> np.uint64(bits * (t % per))) & mask != 0
            i, j = i[new], j[new]
        marks[0][i + k] = True
        marks[1][j] = True
    if alone:
        return group.filter(pa.array(marks[0] | marks[1])).select(_CELL)
    return pa.concat_tables([side.filter(pa.array(m)) for side, m in zip((left, right), marks)]).select(_CELL)


def _join(least: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Let ``least``, the least place that each place reaches, take in the links of i with j."""
    while True:
        a, b = least[i], least[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (least[least] != least).any():
            least[:] = least[least]


def _cell(cosine: float, kind: str, group: pa.Table) -> pa.Table:
    """Links between the two blocks of a cell, those of earlier tables left out.

    Rows (a, b, weight): with b null, the copies that ``a`` links with; else a link of a spanning
    forest of its links. So a cell gives a few rows a vector, however many links there are.
    """
    out: list[tuple] = []
    spaces = list(zip(*(group.column(c).to_pylist() for c in ("label", "dim"))))
    for space in sorted(set(spaces)):  # one, unless two buckets' keys are equal by chance
        left, right, alone = _sides(group.filter(pa.array([x == space for x in spaces])))
        if not left.num_rows or not right.num_rows:
            continue
        table = group.column("at")[0].as_py()
        x, y = (_unit(side.column("vector").to_pylist(), kind) for side in (left, right))
        codes = [np.array(side.column("codes").to_pylist())[:, :table] for side in (left, right)]
        ids = [side.column("cls").to_pylist() for side in (left, right)]
        copies = [side.column("copies").to_numpy() for side in (left, right)]
        weights = np.zeros(left.num_rows), np.zeros(right.num_rows)
        second = 0 if alone else left.num_rows
        least = np.arange(second + right.num_rows)
        for k in range(0, left.num_rows, CHUNK):
            i, j = np.nonzero(x[k : k + CHUNK] @ y.T >= cosine)
            i += k
            if alone:
                i, j = i[i < j], j[i < j]
            for t in range(table):
                new = codes[0][i, t] != codes[1][j, t]
                i, j = i[new], j[new]
            weights[0][:] += np.bincount(i, copies[1][j], minlength=left.num_rows)
            weights[1][:] += np.bincount(j, copies[0][i], minlength=right.num_rows)
            _join(least, i, j + second)
        for own, weight in zip(ids, weights):
            out += [(own[p], None, int(weight[p])) for p in np.flatnonzero(weight)]
        every = ids[0] if alone else ids[0] + ids[1]
        out += [(every[p], every[least[p]], 0) for p in np.flatnonzero(least != np.arange(len(least)))]
    return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], ["a", "b", "weight"])


def near_duplicates(
    spark: SparkSession,
    vectors: DataFrame,
    cosine: float = LEAST_COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tables: Tables | None = None,
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (least id reachable by links) and ``kept``.

    Two vectors link if their labels and lengths are equal and their cosine, in doubles, is at
    least ``cosine``. Equal vectors of a label are one class that counts its copies. Classes are
    hashed by the signs of their products with random planes, in several tables (``plan``); the
    bucket of a label and hash is cut into blocks, and each pair of blocks is a cell of its own,
    so no bucket is held in one task. What is dealt to the cells is 16 bytes of signs a class and
    table, not vectors: only classes with another one near by those signs (``sketch_plan``) have
    their vectors fetched, for the cells where they have it, and compared exactly. A pair counts in
    the first table that brings it together. A cell returns link counts and a spanning forest, not
    its pairs. The chances to miss a pair, by the tables and by the signs, are ``MISS`` together.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a
    null id or label, have no links and are kept. Rows that repeat an id and vector count as
    copies; rows that repeat an id with another vector share a component, and have the greater
    of their counts. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "embeddings")
    given = vectors.select(F.col(f"`{vector_col}`")).schema[0].dataType
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    kind, name = ("<f4", "float") if single else ("<f8", "double")
    source = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), F.col(f"`{vector_col}`").cast(f"array<{name}>").alias("vector")
    )
    valid = tables.put(_vectors(source, kind), "valid")
    by = ["label", "dim", "d1", "d2"]
    grouped = valid.groupBy(*by).agg(F.min("id").alias("cid"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    classes = tables.put(grouped.withColumn("cls", F.monotonically_increasing_id()), "classes")
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, n_tables = plan(largest, cosine, MISS / 2)
    per, most = sketch_plan(bits, cosine, MISS / 2)
    signed = tables.put(_signed(classes, kind, bits, n_tables, per), "signed")
    hashed = signed.select("label", "dim", "cls", "hi", "lo", F.posexplode("codes").alias("at", "code"))
    hashed = hashed.select(F.xxhash64("label", "dim", "at", "code").alias("key"), "at", "cls", "hi", "lo")
    sizes = hashed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    dealt = hashed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("size") / BLOCK)).drop("size")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cells = dealt.withColumn("other", F.explode(every)).select(
        "key", "at", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "cls", "hi", "lo",
    )
    near = cells.groupBy("key", "i", "j").applyInArrow(
        lambda g: _near(bits, per, most, g), "key long, at int, i long, j long, side int, cls long"
    )
    near = tables.put(near, "near")
    met = near.join(signed.drop("hi", "lo"), "cls")
    found = tables.put(met.groupBy("key", "i", "j").applyInArrow(lambda g: _cell(cosine, kind, g), "a long, b long, weight long"), "found")
    tables.drop(near, signed)
    counts = found.filter("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("weight").alias("others"))
    own = tables.put(valid.join(classes.select(*by, "cls", "cid", "copies"), by).select("id", "cls", "cid", "copies"), "own")
    ids = classes.select(F.col("cls").alias("b"), F.col("cid").alias("least_b")), classes.select(F.col("cls").alias("a"), F.col("cid").alias("least_a"))
    links = found.filter("b is not null").join(ids[0], "b").join(ids[1], "a").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    components = connected_components(tables, links.union(own.select(F.col("id").alias("a"), F.col("cid").alias("b"))))
    n = F.max(F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    linked = own.join(counts, "cls", "left").groupBy("id").agg(n)
    result = source.select("id").join(linked, "id", "left").join(components, "id", "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
