"""Prefix trie of conversations: union-find over the edges between sorted neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearledger.llm.common import Tables

SEGMENT = 4096  # turns of a conversation that one row holds at most
FOREST_TURNS = 1 << 16  # turns that one local forest is built of, about
_OF_BASE = range(-4, 5)  # what Spark's remainder by 5 may be
_ROWS = (
    "path long, seg long, depth long, p1 long, p2 long, n long, least long, children long, leaves long, saved long, bytes long, "
    "goes_on boolean, parent long, q1 long, q2 long"
)


def numbered(tables: Tables, conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, bytes): every turn's place in its conversation from 0, two hashes of
    its role and text, and the text's UTF-8 bytes.

    Turns are ordered by turn (null first), role and text. The rows are sorted by ranges, numbered
    where they lie, and shifted by the counts of the partitions before, so that a conversation may
    span any number of tasks.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(
        F.col("conv_id").cast("long"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    ).filter("conv_id is not null")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    hashed = dealt.select(
        "conv_id", F.spark_partition_id().alias("part"), F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit(1), "text", "role").alias("b"), F.octet_length("text").cast("long").alias("bytes"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, before = None, None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            sizes = np.diff(np.append(starts, len(conv)))
            pos = np.arange(len(conv)) - np.repeat(starts, sizes)
            if conv[0] == last:
                pos[: sizes[0]] += before
            if first is None or conv[0] == first[0]:
                first = int(conv[0]), int(pos[sizes[0] - 1]) + 1
            last, before = int(conv[-1]), int(pos[-1]) + 1
            part = batch.column("part")[0].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pos)], [*batch.schema.names, "pos"])
        if first:
            edges = dict([first, (last, before)])
            none = pa.nulls(len(edges), pa.int64())
            columns = [list(edges), pa.array([part] * len(edges), pa.int32()), none, none, none, list(edges.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["conv_id", "part", "a", "b", "bytes", "pos"])

    stored = tables.put(hashed.mapInArrow(run, "conv_id long, part int, a long, b long, bytes long, pos long"), "turns")
    edges = stored.filter("bytes is null")  # counts of each task's first and last conversation, which others may go on with
    by_conv = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = edges.select("conv_id", "part", F.sum("pos").over(by_conv).alias("shift")).filter("shift is not null")
    placed = stored.filter("bytes is not null").join(F.broadcast(shifts), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos"), "a", "b", "bytes")


def _kept(conv_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(conv_id.cast("string"), "UTF-8")), F.lit(9))


def rebuilt(spark: SparkSession, conversations: DataFrame, tables: Tables | None = None) -> DataFrame:
    """Turns of the rebuilt conversations: (conv_id, depth from 0, one, two, bytes), in hashes.

    Conversation c gets the first h turns of conversation c - c % 5 (all if fewer, none if absent),
    then its own turns after its first h; h is the crc32 of its number, modulo 9. A conversation
    without turns is one row with a null depth.

    Null roles and texts are empty. Rows without a conv_id are no conversation and left out; rows
    that repeat are turns of their own, and turns with the same number go by role, then text.
    Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "trie")
    turns = numbered(tables, conversations)
    turns = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    # One row a base, with the number of turns of each conversation that begins with it.
    counts = turns.groupBy("base").agg(*[F.count_if(F.col("conv_id") - F.col("base") == r).alias(f"n{r}") for r in _OF_BASE])
    member = lambda r: F.struct(
        (F.col("base") + r).alias("id"), F.col(f"n{r}").alias("n"), _kept(F.col("base") + r).alias("h"), F.least(_kept(F.col("base") + r), F.col("n0")).alias("given")
    )
    groups = counts.select("base", F.filter(F.array(*[member(r) for r in _OF_BASE]), lambda m: m["n"] > 0).alias("members"))
    target = lambda conv_id, depth: F.struct(conv_id.alias("conv_id"), depth.alias("depth"))
    id_, pos = F.col("conv_id"), F.col("pos")
    own = F.transform(F.filter("members", lambda m: (m["id"] == id_) & (pos >= m["h"])), lambda m: target(id_, pos - m["h"] + m["given"]))
    given = F.transform(F.filter("members", lambda m: (id_ == F.col("base")) & (pos < m["given"])), lambda m: target(m["id"], pos))
    dealt = turns.join(groups, "base").select(F.explode(F.concat(own, given)).alias("to"), "a", "b", "bytes").select("to.*", "a", "b", "bytes")
    none = groups.select(F.explode(F.filter("members", lambda m: (m["given"] == 0) & (m["n"] <= m["h"]))).alias("m"))
    none = none.select(F.col("m.id").alias("conv_id"), *[F.lit(None).cast("long").alias(c) for c in ("depth", "one", "two", "bytes")])
    at = F.col("depth")
    hashed = dealt.select(
        "conv_id", "depth", F.xxhash64(at, "a", "b").alias("one"), F.xxhash64(F.lit(7), "b", at, "a").alias("two"), "bytes"
    )
    return tables.put(hashed.union(none), "rebuilt")


class _Component:
    """A run of sorted neighbours, from ``lo`` to ``hi``; its node is ``depth`` turns deep.

    ``children``, ``leaves`` and ``saved`` are those below the node; ``tops`` are the chains that
    wait for this node as their parent.
    """

    __slots__ = ("lo", "hi", "depth", "n", "least", "children", "leaves", "saved", "goes_on", "tops")

    def __init__(self, lo, hi, depth, n, least, children, leaves, saved, goes_on, tops):
        self.lo, self.hi, self.depth, self.n, self.least = lo, hi, depth, n, least
        self.children, self.leaves, self.saved, self.goes_on, self.tops = children, leaves, saved, goes_on, tops


class Forest:
    """Trie nodes of a run of sorted entries.

    Edges between neighbours are merged in descending depth of what the two have in common. A
    merge makes the branching node at that depth; the nodes above a component's own, down to the
    one it merges into, are a chain with the same members. Nodes on the path of the first or the last entry may go on in
    the runs beside; those are given as partial rows with the number of a path.
    """

    def __init__(self, entries: list[dict], path: int, segment: int):
        self.entries, self.path, self.segment = entries, path, segment
        self.last = len(entries) - 1
        self.chains: list[dict] = []
        self.prefixes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.fresh = path + 2

    def _prefix(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the first d turns of entry ``i``, for each d."""
        found = self.prefixes.get(i)
        if found is None:
            e = self.entries[i]
            found = tuple(
                np.bitwise_xor.accumulate(np.concatenate([[g], e["codes"][k::2]]).astype(np.int64)) for k, g in enumerate((e["g1"], e["g2"]))
            )
            self.prefixes[i] = found
        return found

    def _common(self, i: int) -> int:
        """How many turns entries ``i`` and ``i + 1`` begin with in common, -1 in different groups."""
        x, y = self.entries[i], self.entries[i + 1]
        if (x["seg"], x["g1"], x["g2"]) != (y["seg"], y["g1"], y["g2"]):
            return -1
        m = min(len(x["codes"]), len(y["codes"]))
        differ = np.flatnonzero(x["codes"][:m] != y["codes"][:m])
        return int(differ[0] if len(differ) else m) // 2

    def _emit(self, c: _Component, depths: np.ndarray, path: int | None, **columns) -> int:
        e = self.entries[c.lo]
        one, two = self._prefix(c.lo)
        own = np.append([0], e["bytes"])[depths]
        k = len(depths)
        row = {
            "path": np.full(k, -1 if path is None else path), "seg": np.full(k, e["seg"]), "depth": depths + e["seg"] * self.segment,
            "p1": one[depths], "p2": two[depths], "n": np.full(k, c.n), "least": np.full(k, c.least),
            "children": np.zeros(k, dtype=np.int64), "leaves": np.zeros(k, dtype=np.int64), "saved": np.zeros(k, dtype=np.int64),
            "bytes": own, "goes_on": np.zeros(k, dtype=bool), "parent": np.full(k, c.least), "by_key": np.zeros(k, dtype=bool),
            "q1": one[np.maximum(depths - 1, 0)], "q2": two[np.maximum(depths - 1, 0)],
        }
        row["goes_on"][0] = c.goes_on
        row.update(columns)
        self.chains.append(row)
        return len(self.chains) - 1

    def _close(self, c: _Component, above: int) -> _Component:
        """Emit the component's nodes deeper than ``above``; what it is for the node there."""
        depths = np.arange(c.depth, above, -1)
        first = np.zeros(len(depths), dtype=np.int64)
        first[0] = 1
        if c.lo == 0 or c.hi == self.last:
            path = self.path if c.lo == 0 else self.path + 1
            self._emit(
                c, depths, path, children=first * c.children, leaves=first * c.leaves, saved=first * c.saved,
                by_key=np.ones(len(depths), dtype=bool),
            )
            for top in c.tops:
                self.chains[top]["by_key"][-1] = True
            return _Component(c.lo, c.hi, above, c.n, c.least, 0, 0, 0, False, [])
        leaves = c.leaves if c.children or c.goes_on else 1
        own = (c.n - 1) * np.append([0], self.entries[c.lo]["bytes"])[depths]
        saved = c.saved + np.cumsum(own)
        top = self._emit(
            c, depths, None, children=np.where(first == 1, c.children, 1), leaves=np.full(len(depths), leaves), saved=saved
        )
        for t in c.tops:
            self.chains[t]["parent"][-1] = c.least
        return _Component(c.lo, c.hi, above, c.n, c.least, 1, leaves, int(saved[-1]), False, [top])

    def build(self) -> list[dict]:
        of = {
            i: _Component(i, i, len(e["bytes"]), e["n"], e["least"], 0, e["leaf0"], e["saved0"], e["more"], [])
            for i, e in enumerate(self.entries)
        }
        root = list(range(len(self.entries)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        common = [self._common(i) for i in range(self.last)]
        for i in sorted((i for i, d in enumerate(common) if d >= 0), key=lambda i: -common[i]):
            a, b = find(i), find(i + 1)
            x, y = (c if c.depth == common[i] else self._close(c, common[i]) for c in (of[a], of.pop(b)))
            root[b] = a
            if len(x.tops) < len(y.tops):
                x.tops, y.tops = y.tops, x.tops
            x.tops.extend(y.tops)
            of[a] = _Component(
                x.lo, y.hi, common[i], x.n + y.n, min(x.least, y.least), x.children + y.children, x.leaves + y.leaves,
                x.saved + y.saved, x.goes_on or y.goes_on, x.tops,
            )
        for c in of.values():
            self._root(c if c.depth == 0 else self._close(c, 0))
        if self.last > 0:
            self._second_path()
        return self.chains

    def _root(self, c: _Component) -> None:
        """The node that a group starts from. That of a later segment also ends the segment before,
        which has its members, so here it has children only."""
        path = self.path if c.lo == 0 else self.path + 1 if c.hi == self.last else self.fresh
        self.fresh += path == self.fresh
        one = np.ones(1, dtype=np.int64)
        later = self.entries[c.lo]["seg"] > 0
        self._emit(
            c, np.zeros(1, dtype=np.int64), path, children=one * c.children, leaves=one * (0 if later else c.leaves),
            saved=one * (0 if later else c.saved), **({"n": one * 0} if later else {}),
        )
        for top in c.tops:
            self.chains[top]["by_key"][-1] = True

    def _second_path(self) -> None:
        """The last entry's path begins with the nodes that it has in common with the first."""
        x, y = self.entries[0], self.entries[self.last]
        if (x["seg"], x["g1"], x["g2"]) != (y["seg"], y["g1"], y["g2"]):
            return
        m = min(len(x["codes"]), len(y["codes"]))
        differ = np.flatnonzero(x["codes"][:m] != y["codes"][:m])
        shared = int(differ[0] if len(differ) else m) // 2
        c = _Component(self.last, self.last, 0, 0, 0, 0, 0, 0, False, [])
        self._emit(c, np.arange(shared, -1, -1), self.path + 1, by_key=np.arange(shared, -1, -1) > 0)


def _forests(entries: DataFrame, segment: int, forest_turns: int) -> DataFrame:
    """Rows of all local forests; of sorted entries, each forest takes ``forest_turns`` turns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = TaskContext.get().partitionId() << 40
        held, turns = [], 0

        def build() -> pa.RecordBatch:
            nonlocal path
            forest = Forest(held, path, segment)
            rows = forest.build()
            path = forest.fresh
            c = {k: np.concatenate([r[k] for r in rows]) for k in rows[0]}
            open_, no_members = c["path"] >= 0, c["n"] == 0
            root = c["depth"] == c["seg"] * segment
            arrays = [
                pa.array(c["path"], pa.int64(), mask=~open_),
                *[pa.array(c[k], pa.int64()) for k in ("seg", "depth", "p1", "p2", "n")],
                pa.array(c["least"], pa.int64(), mask=no_members),
                *[pa.array(c[k], pa.int64()) for k in ("children", "leaves", "saved", "bytes")],
                pa.array(c["goes_on"]),
                pa.array(c["parent"], pa.int64(), mask=c["by_key"] | open_),
                *[pa.array(c[k], pa.int64(), mask=~c["by_key"] | root) for k in ("q1", "q2")],
            ]
            return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _ROWS.split(", ")])

        for batch in batches:
            names = [n for n in batch.schema.names if n not in ("codes", "bytes")]
            columns = {n: batch.column(n).to_pylist() for n in names}
            for i in range(batch.num_rows):
                entry = {n: columns[n][i] for n in names}
                entry["codes"] = batch.column("codes")[i].values.to_numpy() if len(batch.column("codes")[i]) else np.zeros(0, dtype=np.int64)
                entry["bytes"] = batch.column("bytes")[i].values.to_numpy() if len(batch.column("bytes")[i]) else np.zeros(0, dtype=np.int64)
                held.append(entry)
                turns += len(entry["bytes"]) + 1
                if turns >= forest_turns:
                    yield build()
                    held, turns = [], 0
        if held:
            yield build()

    order = ["seg", "g1", "g2", "codes", "least"]
    return entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _ROWS)


def _merged(tables: Tables, rows: DataFrame) -> DataFrame:
    """The open nodes of all forests, each once: partial rows of one node are added up.

    What hangs below an open node lies in closed nodes, which the partial rows already count, and
    in open ones. Each open node's own part is put on one of the paths it is on, and summed along
    that from its end; a node's total is the sum over all paths through it.
    """
    key = ["seg", "depth", "p1", "p2"]
    open_ = rows.filter("path is not null")
    once = open_.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in ("n", "children")], F.min("least").alias("least"), F.max("bytes").alias("bytes"),
        F.max("goes_on").alias("goes_on"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min("path").alias("path"),
    )
    once = tables.put(once, "open")
    kids = once.filter("q1 is not null").groupBy("seg", (F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    once = once.join(kids.agg(F.count("*").alias("more")), key, "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    once = tables.put(once.drop("more"), "merged")
    leaf = (F.col("n") > 0) & (F.col("children") == 0) & ~F.col("goes_on")
    own = once.select(*key, "path", leaf.cast("long").alias("is_leaf"), (F.greatest(F.col("n") - 1, F.lit(0)) * F.col("bytes")).alias("own"))
    along = open_.select(*key, "path", "leaves", "saved").join(own, [*key, "path"], "left")
    upward = Window.partitionBy("path").orderBy(F.desc("depth"))
    summed = along.select(
        *key,
        F.sum(F.col("leaves") + F.coalesce("is_leaf", F.lit(0))).over(upward).alias("leaves"),
        F.sum(F.col("saved") + F.coalesce("own", F.lit(0))).over(upward).alias("saved"),
    )
    totals = summed.groupBy(*key).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return tables.put(once.drop("path").join(totals, key), "totals")


def _nodes(tables: Tables, entries: DataFrame, segment: int, forest_turns: int) -> DataFrame:
    """All nodes: (seg, depth, p1, p2, n, least, children, leaves, saved, bytes, goes_on, parent)."""
    rows = tables.put(_forests(entries, segment, forest_turns), "forests")
    whole = _merged(tables, rows)
    columns = ["seg", "depth", "p1", "p2", "n", "least", "children", "leaves", "saved", "bytes", "goes_on"]
    closed = rows.filter("path is null").select(*columns, "parent", "q1", "q2")
    both = closed.unionByName(whole.filter("n > 0").select(*columns, F.lit(None).cast("long").alias("parent"), "q1", "q2"))
    border = (F.col("depth") > 0) & (F.col("depth") % segment == 0)
    later = whole.filter("n = 0").select("depth", "p1", "p2", F.col("children").alias("more"))
    both = both.join(later, ["depth", "p1", "p2"], "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    at_border = rows.filter(F.col("path").isNull() & border).select("depth", "p1", "p2", "least")
    anchors = whole.filter("n > 0").select("depth", "p1", "p2", "least").union(at_border)
    known = anchors.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("least").alias("by_key"))
    named = both.join(tables.put(known, "anchors"), ["depth", "q1", "q2"], "left")
    return named.select(*columns, F.coalesce("parent", "by_key").alias("parent"))


def _ends(convs: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of every distinct conversation.

    The digest of a list needs its numbers one after another, so each list passes through one
    task as a sorted stream of which a batch is held.
    """
    order = ["depth", "p1", "p2", "conv_id"]
    dealt = convs.select(*order).repartition("depth", "p1", "p2").sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(),) * 3 + (pa.string(),))]
            return pa.RecordBatch.from_arrays(columns, ["depth", "p1", "p2", "ends_sha256"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in order[:3]], axis=1)
            ids = batch.column("conv_id").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(ids) else []
            for lo, hi in zip(starts, [*starts[1:], len(ids)]):
                key = tuple(keys[lo].tolist())
                text = ",".join(map(str, ids[lo:hi])).encode()
                if key == now:
                    digest.update(b"," + text)
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(text)
            if done:
                yield flush()
                done = []
        if now is not None:
            done = [(*now, digest.hexdigest())]
            yield flush()

    return dealt.mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(
    spark: SparkSession, turns: DataFrame, segment: int = SEGMENT, forest_turns: int = FOREST_TURNS, tables: Tables | None = None
) -> DataFrame:
    """Every distinct sequence of first turns: conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` are those of ``rebuilt``: (conv_id, depth, one, two, bytes), two hashes of the turn and its depth; a
    null depth is a conversation without turns.

    1. A conversation's turns are gathered in rows of ``segment`` turns at most, so its length is
       not bounded by a task. Equal conversations become one, with their number and smallest id.
    2. Segments that begin after the same turns are a group. All are sorted by ranges, and each
       run of ``forest_turns`` turns becomes a ``Forest`` of its own by union-find, wherever it is
       cut; so neither a first turn nor a conversation that a third of all have falls to one task.
    3. Only the nodes on the first and last path of each forest are open. Those, contracted, are
       merged across the boundaries by their key: depth and the exclusive-or of the turns' hashes.
    4. With several segments, what each has below it in later ones is known after one round, by
       smallest members, and a second round adds it up.

    Nodes are told apart by 128 bits of hashes. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "trie")
    some = turns.filter("depth is not null").withColumn("seg", F.expr(f"depth div {segment}"))
    packed = some.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("depth", "one", "two", "bytes"))).alias("t"),
        F.bit_xor("one").alias("x1"), F.bit_xor("two").alias("x2"), F.count("*").alias("k"),
    )
    segments = tables.put(
        packed.select(
            "conv_id", "seg", F.flatten(F.transform("t", lambda t: F.array(t["one"], t["two"]))).alias("codes"),
            F.transform("t", lambda t: t["bytes"]).alias("bytes"), "x1", "x2", "k",
        ),
        "segments",
    )
    several = not segments.filter("seg > 0").isEmpty()
    zero = F.lit(0).cast("long")
    none = turns.filter("depth is null").select("conv_id", zero.alias("depth"), zero.alias("p1"), zero.alias("p2"))
    if several:
        convs = segments.groupBy("conv_id").agg(F.sum("k").alias("depth"), F.bit_xor("x1").alias("p1"), F.bit_xor("x2").alias("p2"))
        convs = tables.put(convs.union(none), "convs")
    else:
        convs = segments.select("conv_id", F.col("k").alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2")).union(none)
    classes = tables.put(convs.groupBy("depth", "p1", "p2").agg(F.min("conv_id").alias("least"), F.count("*").alias("n")), "classes")
    heads = classes.select(F.col("least").alias("conv_id"), "n", F.col("depth").alias("length"))
    entries = segments.join(heads, "conv_id")
    if several:
        before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
        long_ = segments.select("conv_id", "seg", "x1", "x2").join(segments.filter("seg = 1").select("conv_id"), "conv_id", "left_semi")
        starts = long_.select("conv_id", "seg", F.bit_xor("x1").over(before).alias("g1"), F.bit_xor("x2").over(before).alias("g2")).filter("seg > 0")
        entries = entries.join(tables.put(starts, "starts"), ["conv_id", "seg"], "left")
    else:
        entries = entries.withColumns({"g1": zero, "g2": zero})
    columns = ["seg", "g1", "g2", "codes", "bytes", "n", "least", "more", "leaf0", "saved0"]
    no_list = F.array().cast("array<long>")
    entries = entries.select(
        "seg", F.coalesce("g1", zero).alias("g1"), F.coalesce("g2", zero).alias("g2"), "codes", "bytes", "n", F.col("conv_id").alias("least"),
        (F.col("length") > (F.col("seg") + 1) * segment).alias("more"), zero.alias("leaf0"), zero.alias("saved0"),
    )
    turnless = classes.filter("depth = 0").select(
        zero.alias("seg"), zero.alias("g1"), zero.alias("g2"), no_list.alias("codes"), no_list.alias("bytes"), "n", "least",
        F.lit(False).alias("more"), zero.alias("leaf0"), zero.alias("saved0"),
    )
    entries = tables.put(entries.union(turnless), "entries")
    nodes = _nodes(tables, entries, segment, forest_turns)
    if several:
        leaf = ((F.col("children") == 0) & ~F.col("goes_on")).cast("long")
        own = nodes.groupBy("least", "seg").agg(F.sum(leaf).alias("leaf"), F.sum((F.col("n") - 1) * F.col("bytes")).alias("own"))
        after = Window.partitionBy("least").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
        below = entries.select("least", "seg").join(own, ["least", "seg"], "left").select(
            "least", "seg", F.coalesce(F.sum("leaf").over(after), zero).alias("leaf0"), F.coalesce(F.sum("own").over(after), zero).alias("saved0")
        )
        entries = entries.drop("leaf0", "saved0").join(below, ["least", "seg"]).select(*columns)
        nodes = _nodes(tables, tables.put(entries, "entries"), segment, forest_turns)
    found = nodes.join(_ends(convs), ["depth", "p1", "p2"], "left")
    return found.select(
        F.col("least").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
