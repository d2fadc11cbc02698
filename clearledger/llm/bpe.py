"""Byte-level BPE: exact backtracking encoder, and a decoder over an offset table."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearledger.llm.common import Memo, text_slices

# Fixed value: the split of a byte-level file with use_regex.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Two white space characters in a row, or one at the end, or one that is no space or line end.
_ODD_SPACE = re.compile(r"\s\s|\s\Z|[^\S \n]")
_NEVER = float("inf")
MEMO_RUNS = 600_000
MEMO_PIECES = 300_000
MEMO_PAIRS = 300_000


def byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level files write bytes: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex")
            and not split.get("add_prefix_space")
        )
        if not plain:
            raise ValueError(f"{path} is no plain byte-level BPE file")
        alphabet = byte_alphabet()
        self.bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in model["vocab"].items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.merge_of: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts_of: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = (model["vocab"][t] for t in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            self.merge_of[a, b] = (rank, whole)
            self.parts_of.setdefault(whole, (a, b, rank))
        self.added: dict[str, int] = {}
        for t in spec.get("added_tokens") or []:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError(f"added token {t['content']!r} needs a context that is not supported")
            self.added[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()


class Encoder:
    """Exact BPE of a piece of text, in time linear in its length.

    At each position the longest token is taken from an Aho-Corasick automaton. A token may
    follow another only if merging their bytes yields just those two tokens; otherwise the next
    shorter token is tried, and the previous one taken back when none is left. A position that
    led to no result is never tried again.
    """

    def __init__(self, path: str):
        self.vocabulary = v = Vocabulary(path)
        self.automaton = ahocorasick.Automaton()
        for token, i in v.id_of.items():
            if len(token) == 1 or self._made(i):
                self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.shorter = {i: self._prefix(t) for i, t in v.bytes_of.items() if v.id_of.get(t) == i}
        self.pairs = Memo(lambda pair: self._compatible(*pair), MEMO_PAIRS)
        self.pieces = Memo(self._piece, MEMO_PIECES)
        self.runs = Memo(self._run, MEMO_RUNS)
        self.specials = re.compile("|".join(map(re.escape, sorted(v.added, key=len, reverse=True)))) if v.added else None

    def _prefix(self, token: bytes) -> int | None:
        """Longest token that is a proper prefix of ``token``."""
        return next((i for n in range(len(token) - 1, 0, -1) if (i := self.automaton.get(token[:n].decode("latin-1"), None)) is not None), None)

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at one edge of ``token`` while it is merged, each with the rank of
        the merge that ends it."""
        found, ends = [], _NEVER
        while True:
            found.append((token, ends))
            if token not in self.vocabulary.parts_of:
                return found
            ends = self.vocabulary.parts_of[token][2]
            token = self.vocabulary.parts_of[token][side]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge joins the two tokens before both are complete.

        Merges run in rank order, equal ranks from the left, so a merge across the border
        happens if its rank comes before the left neighbour's next merge and not after the
        right one's.
        """
        starts = self._edge(right, 0)
        for a, a_ends in self._edge(left, 1):
            for b, b_ends in starts:
                merge = self.vocabulary.merge_of.get((a, b))
                if merge and merge[0] < a_ends and merge[0] <= b_ends:
                    return False
        return True

    def _made(self, token: int) -> bool:
        """Whether merging its bytes yields the token."""
        parts = self.vocabulary.parts_of.get(token)
        return parts is not None and self._reached(*parts)

    def _reached(self, a: int, b: int, rank: int) -> bool:
        for x, x_ends in self._edge(a, 1):
            for y, y_ends in self._edge(b, 0):
                merge = self.vocabulary.merge_of.get((x, y))
                if merge and merge[0] < min(x_ends, rank) and merge[0] <= min(y_ends, rank):
                    return False
        return True

    def tokens(self, piece: bytes) -> list[int]:
        size = len(piece)
        longest: list[int | None] = [None] * size
        lengths = self.vocabulary.bytes_of
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - len(lengths[token])
            longest[start] = token  # ends only grow, so the last one is the longest
        usable = bytearray(b"\x01") * (size + 1)
        tokens: list[int] = []
        at, token, pairs, shorter = 0, longest[0] if size else None, self.pairs, self.shorter
        while token is not None:
            end = at + len(lengths[token])
            if usable[end] and (not tokens or pairs[tokens[-1], token]):
                tokens.append(token)
                at = end
                token = longest[at] if at < size else None
                continue
            token = shorter[token]
            if token is None:
                usable[at] = 0
                if not tokens:
                    raise ValueError("a byte has no token")
                token = tokens.pop()
                at -= len(lengths[token])
        return tokens

    def _piece(self, piece: str) -> bytes:
        ids = self.tokens(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, PIECES.findall(text)))

    def _run(self, run: str) -> bytes:
        """Ids of a run after a space, or of a line end and the run after it."""
        return self._pieces(run if run[0] == "\n" else f" {run}")

    def _plain(self, text: str) -> bytes:
        """Where each space or line end stands alone, pieces never cross from one run of other
        characters to the next, so runs are looked up whole."""
        if _ODD_SPACE.search(text):
            return self._pieces(text)
        first, *runs = text.replace("\n", " \n").split(" ")
        return self._pieces(first) + b"".join(map(self.runs.__getitem__, runs))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self._plain(text[at : m.start()]), np.uint32(self.vocabulary.added[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])


class Decoder:
    """Bytes of ids, looked up by offset in one table of all token bytes."""

    def __init__(self, path: str):
        tokens = Vocabulary(path).bytes_of
        sizes = np.zeros(max(tokens) + 2, dtype=np.int64)
        for i, t in tokens.items():
            sizes[i + 1] = len(t)
        self.offsets = np.cumsum(sizes)
        self.table = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        before = np.cumsum(sizes) - sizes
        at = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
        return self.table[at].tobytes().decode("utf-8", errors="replace")


_CODERS: dict[tuple[type, str], object] = {}


def _coder(kind: type, path: str):
    if (kind, path) not in _CODERS:
        _CODERS[kind, path] = kind(path)
    return _CODERS[kind, path]


def _lists(encoded: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(e) // 4 for e in encoded]]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(encoded), dtype="<u4").astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _over(docs: DataFrame, id_col: str, value: str, make, schema: str) -> DataFrame:
    """Run ``make`` over slices of (id, value) and give the id its own name again."""
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{value}`").alias("value"))
    arrow_id = to_arrow_type(source.schema["id"].dataType)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in make(batches):
            names = list(part)
            ids = part.pop("id").cast(arrow_id)
            yield pa.RecordBatch.from_arrays([ids, *part.values()], names)

    id_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {id_type}, {schema}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ids`` (array of int) of each whole text, as the file's own library encodes it.

    One row per row of ``docs``, no shuffle. Null and empty texts give an empty array. Added
    tokens written in a text count as such. Null and repeated ids pass through; other columns
    are ignored, whatever their names; an empty table gives no rows.
    """

    def make(batches):
        encoder = _coder(Encoder, tokenizer)
        for part in text_slices(batches, "value"):
            texts = part.column("value").to_pylist()
            yield {"id": part.column("id"), "ids": _lists([encoder.encode(t or "") for t in texts])}

    return _over(docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string")), id_col, text_col, make, "ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``text`` of each array of ids. Bytes that are no UTF-8 become U+FFFD; null stays null."""

    def make(batches):
        decoder = _coder(Decoder, tokenizer)
        for batch in batches:
            lists = batch.column("value")
            texts = [None if x is None else decoder.decode(np.asarray(x, dtype=np.int64)) for x in lists.to_pylist()]
            yield {"id": batch.column("id"), "text": pa.array(texts, pa.string())}

    return _over(encoded, id_col, ids_col, make, "text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ids`` of each text and the ``text`` that these ids decode to, in one pass over the rows.

    The same as ``decode(encode(docs))`` joined with ``encode(docs)``, with the same treatment of
    nulls, repeated rows and other columns.
    """

    def make(batches):
        encoder, decoder = _coder(Encoder, tokenizer), _coder(Decoder, tokenizer)
        for part in text_slices(batches, "value"):
            encoded = [encoder.encode(t or "") for t in part.column("value").to_pylist()]
            texts = [decoder.decode(np.frombuffer(e, dtype="<u4").astype(np.int64)) for e in encoded]
            yield {"id": part.column("id"), "ids": _lists(encoded), "text": pa.array(texts, pa.string())}

    return _over(docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string")), id_col, text_col, make, "ids array<int>, text string")
