"""Fuzzy line de-duplication: MinHash bands over character shingles, one line kept a component."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearledger.llm import linking
from clearledger.llm.common import Tables, numbered, private, slices
from clearledger.llm.shingles import distinct, mix

WIDTH = 8
MIN_CHARS = 40
BANDS, BAND_ROWS = 12, 3
#: Lines with fewer shingles get minima of many hashes, from three quarters of that on also
#: minima of bins of one hash; so two similar lines always have one of both in common.
FEW = 128
_SIGNATURE = BANDS * BAND_ROWS
_PART, _LINES = 1 << 16, 1 << 13
_BIN_BITS, _REST = 6, 45  # beside the 13 bits of a line's number in a part
_SEEDS = mix(np.arange(1, _SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SEEDS_32, _FACTOR_32 = (_SEEDS >> np.uint64(32)).astype(np.uint32), np.uint32(0x9FB21C65)
_ODD = np.arange(1, 2 * BAND_ROWS, 2, dtype=np.uint64)
_ODD_SPACES = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"]
_ODD_ASCII = [c for c in _ODD_SPACES if c.isascii()]


def normal(line: str) -> str:
    """Lower case, white space as single spaces, none at the ends."""
    return " ".join(line.lower().split())


def line_id(line: str) -> int:
    """64-bit hash of a normalised line, signed."""
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def _rolling(codes: np.ndarray) -> np.ndarray:
    """Hashes of all runs of eight code points."""
    h = mix(codes.astype(np.uint64))
    for step, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x9FB21C651E98DF25), (4, 0xD6E8FEB86659FD93)):
        h = h[:-step] * np.uint64(factor) + h[step:]
    return mix(h)


def char_shingles(line: str) -> np.ndarray:
    """Sorted distinct hashes of a normalised line's runs of eight characters."""
    return many_char_shingles([line])[0]


def many_char_shingles(lines: list[str]) -> list[np.ndarray]:
    """``char_shingles`` of each line, hashed in parts of about ``_PART`` characters."""
    made, start, chars = [], 0, 0
    for end, line in enumerate(lines, 1):
        chars += len(line) + 1
        if chars >= _PART or end == len(lines):
            made += _char_shingles(lines[start:end])
            start, chars = end, 0
    return made


def _char_shingles(lines: list[str]) -> list[np.ndarray]:
    codes = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le"), dtype="<u4")
    if len(codes) <= WIDTH:
        return [np.zeros(0, dtype=np.uint64) for _ in lines]
    hashes = _rolling(codes)
    fresh = np.zeros(len(hashes), dtype=bool)  # first of equal ones, inside a line
    cuts, at = [], 0
    for x in lines:
        stop = max(at, at + len(x) + 1 - WIDTH)
        hashes[at:stop].sort()
        cuts += (at, stop)
        at += len(x) + 1
    fresh[0], fresh[1:] = True, hashes[1:] != hashes[:-1]
    inside = np.zeros(len(hashes) + 1, dtype=np.int8)
    starts, stops = np.array(cuts[::2]), np.array(cuts[1::2])
    some = stops > starts
    fresh[starts[some]] = True
    inside[starts[some]] = 1
    inside[stops[some]] -= 1
    fresh &= np.cumsum(inside, dtype=np.int8)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(fresh)])
    hashes = hashes[fresh]
    return [hashes[i:j] for i, j in zip(total[np.minimum(starts, len(fresh))].tolist(), total[np.minimum(stops, len(fresh))].tolist())]


def _keys(signature: np.ndarray, kind: int) -> np.ndarray:
    """One key a band, from rows of ``_SIGNATURE`` minima."""
    rows = mix(signature.reshape(-1, BANDS, BAND_ROWS) + (np.arange(BANDS, dtype=np.uint64)[None, :, None] + np.uint64(1000 * kind)))
    return mix(np.bitwise_xor.reduce(rows * _ODD, axis=2))


def signatures(lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Band keys of normalised lines: (numbers of lines, sizes of their sets, keys by line).

    Lines go in parts of about ``_PART`` characters, which stay in the cache, and of ``_LINES``
    lines at most, for whose numbers there is room; so it does not matter how many there are.
    """
    start, chars = 0, 0
    for end, line in enumerate(lines, 1):
        chars += len(line) + 1
        if chars >= _PART or end - start == _LINES or end == len(lines):
            for number, sizes, keys in _signatures(lines[start:end]):
                yield number + start, sizes, keys
            start, chars = end, 0


def _signatures(lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """One sort, by line, bin and the rest of the hash, gives distinct shingles and least ones of bins."""
    lengths = np.array([len(x) + 1 for x in lines])
    codes = np.frombuffer(("\n".join(lines) + "\n").encode("utf-32-le"), dtype="<u4")
    if len(codes) < WIDTH + 1:
        return
    hashes = _rolling(codes)
    over = np.cumsum(lengths)[:, None] - np.arange(1, WIDTH + 1)  # runs over the end of a line
    whole = np.ones(len(hashes), dtype=bool)
    whole[over[(over >= 0) & (over < len(hashes))]] = False
    v = hashes[whole]
    owner = np.repeat(np.arange(len(lines), dtype=np.uint64) << np.uint64(_BIN_BITS), np.maximum(lengths - WIDTH, 0))
    owner += v
    owner -= v // np.uint64(_SIGNATURE) * np.uint64(_SIGNATURE)  # a division by a constant is faster than the remainder
    owner <<= np.uint64(_REST)
    v >>= np.uint64(64 - _REST)
    owner |= v
    packed = distinct(owner)
    if not len(packed):
        return
    cuts = np.searchsorted(packed, np.arange(1, len(lines), dtype=np.uint64) << np.uint64(_REST + _BIN_BITS))
    sizes = np.diff(np.concatenate([[0], cuts, [len(packed)]]))
    lines_with = np.flatnonzero(sizes)
    sizes = sizes[lines_with]
    few = sizes < FEW
    if few.any():
        at = np.cumsum(sizes[few]) - sizes[few]
        v = mix(packed[np.repeat(few, sizes)] & np.uint64((1 << (_REST + _BIN_BITS)) - 1))
        # Minima of 32 bits take half the time; equal ones of different shingles only propose a pair in vain.
        v = (v >> np.uint64(32)).astype(np.uint32)
        least, each = np.empty((_SIGNATURE, len(at)), dtype=np.uint32), np.empty_like(v)
        for k, s in enumerate(_SEEDS_32):
            np.bitwise_xor(v, s, out=each)
            np.multiply(each, _FACTOR_32, out=each)
            np.minimum.reduceat(each, at, out=least[k])
        yield lines_with[few], sizes[few], _keys(least.T.astype(np.uint64, order="C"), 0)
    many = 4 * sizes >= 3 * FEW
    if many.any():
        order = packed[np.repeat(many, sizes)]
        cells = order >> np.uint64(_REST)
        first = np.concatenate([[True], cells[1:] != cells[:-1]])
        firsts = cells[first].astype(np.int64)
        bins = firsts & ((1 << _BIN_BITS) - 1)
        rows = np.searchsorted(lines_with[many], firsts >> _BIN_BITS)
        least = np.zeros((int(many.sum()), _SIGNATURE), dtype=np.uint64)
        filled = np.zeros(least.shape, dtype=bool)
        filled[rows, bins] = True
        least[rows, bins] = order[first] & np.uint64((1 << _REST) - 1)
        full, given = filled, least
        for shift in range(1, _SIGNATURE):  # an empty bin borrows from the next full one
            if filled.all():
                break
            lend = ~filled & np.roll(full, -shift, axis=1)
            least = np.where(lend, np.roll(given, -shift, axis=1) + np.uint64(shift * 0x9E3779B97F), least)
            filled = filled | lend
        yield lines_with[many], sizes[many], _keys(least, 1)


def _plain(text: str) -> bool:
    """Whether all white space is ends of lines and single spaces between words."""
    odd = _ODD_ASCII if text.isascii() else _ODD_SPACES
    edges = text.startswith(" ") or text.endswith(" ") or "  " in text or " \n" in text or "\n " in text
    return not (edges or any(c in text for c in odd))


def _lines_of(text: str | None, least: int) -> Iterator[tuple[int, str]]:
    """Number and normalised form of each line with a word that has ``least`` characters.

    Where white space is normal already, the text is lowered at once; no character's lower case depends on
    what is beyond an end of line.
    """
    text = text or ""
    if _plain(text) and len(lower := text.lower()) == len(text):
        for k, line in enumerate(lower.split("\n")):
            if line and len(line) >= least:
                yield k, line
        return
    for k, line in enumerate(text.split("\n")):
        if len(line) >= least and len(x := normal(line)) >= max(1, least):
            yield k, x


def _line_texts(part: pa.RecordBatch, least: int) -> Iterator[tuple[int, str]]:
    for text in part.column("text").to_pylist():
        for _, line in _lines_of(text, least):
            yield line_id(line), line


def _occurrences(source: DataFrame, least: int) -> DataFrame:
    """(id, row, line_no, line_id, fresh) of every line; ``fresh`` is the first of equal ones in a task, if it has a shingle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                numbers, found, ends, fresh = [], [], [], []
                for text in part.column("text").to_pylist():
                    for k, line in _lines_of(text, least):
                        x = line_id(line)
                        first = len(line) >= WIDTH and x not in seen
                        if first:
                            seen.add(x)
                        numbers.append(k)
                        found.append(x)
                        fresh.append(first)
                    ends.append(len(found))
                owner = pa.array(np.repeat(np.arange(len(ends)), np.diff([0, *ends])))
                columns = [part.column(c).take(owner) for c in ("id", "row")]
                columns += [pa.array(numbers, pa.int64()), pa.array(found, pa.int64()), pa.array(fresh, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "row", "line_no", "line_id", "fresh"])

    return source.mapInArrow(run, "id long, row long, line_no long, line_id long, fresh boolean")


def _line_keys(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(key, id, n) of every line of ``text`` that has a shingle: its band keys, its id, the size of its set; once a task."""
    seen: set[int] = set()
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            fresh: dict[int, str] = {}
            for text in part.column("text").to_pylist():
                for _, line in _lines_of(text, least):
                    if len(line) >= WIDTH and (x := line_id(line)) not in seen:
                        seen.add(x)
                        fresh[x] = line
            ids = np.array(list(fresh), dtype=np.int64)
            # Lines around FEW shingles have keys of both kinds, in two rows.
            for number, sizes, keys in signatures(list(fresh.values())) if fresh else ():
                offsets = pa.array(np.arange(len(number) + 1, dtype=np.int32) * BANDS)
                lists = pa.ListArray.from_arrays(offsets, keys.reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays([lists, pa.array(ids[number]), pa.array(sizes.astype(np.int64))], ["key", "id", "n"])


def fuzzy_lines(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tables: Tables | None = None,
    least_chars: int = MIN_CHARS,
    row_col: str | None = None,
) -> DataFrame:
    """Per line of at least ``least_chars`` characters (1: every line with a word): id, ``line_no`` (from 0), the id and number
    of the line ``first`` in its component, and ``kept`` (whether it is that line).

    Lines are compared in lower case and with single spaces. Two link if the Jaccard similarity
    of their sets of eight-character shingles is 0.75 or more. ``BANDS`` keys of ``BAND_ROWS``
    minima propose pairs (a pair at 0.75 shares none with a chance of 0.0014, at 0.85 of 1e-5),
    the full sets decide, and components come from ``linking``. Of each component the line with
    the least id and number is kept. Equal lines are one line throughout, by a 64-bit hash, so a
    line that a third of all documents have is compared once. Lines under ``WIDTH`` characters
    have no shingle and link only if they are equal.

    Shorter lines than ``least_chars`` are never touched and not in the result, nor are lines of
    null or empty texts.
    Rows that repeat an id count as one document; null ids come first. With ``row_col``, a column
    of distinct numbers, each row is a document of its own, and the result has that column. Other columns are ignored,
    whatever their names. An empty table gives no rows.
    """
    tables = tables or Tables(spark, "lines")
    row = F.col(f"`{row_col}`") if row_col else F.lit(0)
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), row.cast("long").alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    places = tables.put(_occurrences(source, least_chars), "places")
    sets = linking.Sets(source.select("text"), partial(_line_texts, least=least_chars), many_char_shingles)
    total = BANDS * places.filter("fresh").count()
    lists = linking.shared_keys_of(tables, sets.source, partial(_line_keys, least=least_chars), total)
    pairs = linking.pairs_in_lists(lists.filter(F.col("size") <= linking.SHORT_LIST)).drop("shared")
    found = linking.components_of(tables, sets, pairs, lists.filter(F.col("size") > linking.SHORT_LIST))
    component = F.coalesce("component", "line_id")
    joined = places.join(found.withColumnRenamed("id", "line_id"), "line_id", "left").select("id", "row", "line_no", component.alias("component"))
    joined = tables.put(joined, "joined")
    first = joined.groupBy("component").agg(F.min(F.struct("id", "row", "line_no")).alias("first"), F.count("*").alias("n"))
    several = first.filter("n > 1").drop("n")
    own = F.struct("id", "row", "line_no")
    result = joined.join(several, "component", "left").select("id", "row", "line_no", F.coalesce("first", own).alias("first"))
    tables.drop(places)
    return result.select(
        F.col("id").alias(id_col), *([F.col("row").alias(row_col)] if row_col else []),
        "line_no", F.col("first.id").alias("first_id"), F.col("first.line_no").alias("first_line_no"),
        own.eqNullSafe(F.col("first")).alias("kept"),
    )


#: A character that ``str.split`` does not take for white space.
_WORD = r"(?U)[^\s\x1c-\x1f]"


def without_lines(text: Column, numbers: Column) -> Column:
    """``text`` without the lines of these numbers (from 0)."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains(numbers, i.cast("long"))), "\n")


def remove_repeated_lines(
    spark: SparkSession, docs: DataFrame, tables: Tables | None = None, least_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` (doc_id, text, n_chars and any others) without the lines that are not kept.

    A document that loses all its lines with a word is a copy and goes. ``n_chars`` follows the
    new text. All other rows and columns stay, null texts and texts without a word included. Each row is a document
    of its own, whatever its id; for that, each has a number (``common.numbered``).
    """
    tables = tables or Tables(spark, "lines")
    row, gone = private("row_number", docs), private("gone_lines", docs)
    rows = numbered(tables, docs, row)
    found = fuzzy_lines(spark, rows, tables=tables, least_chars=least_chars, row_col=row)
    removed = found.filter("not kept").groupBy(row).agg(F.collect_set("line_no").alias(gone))
    joined = rows.join(removed, row, "left")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(without_lines(F.col("text"), F.col(gone)))
    left = joined.withColumn("text", text).filter(F.col(gone).isNull() | F.col("text").rlike(_WORD))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.char_length("text")))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
