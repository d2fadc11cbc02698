"""Sum-of-squares online packing of tokenised documents into windows of equal length."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearledger.llm.bpe import byte_alphabet
from clearledger.llm.common import Memo, text_slices

MAX_OPEN_WINDOWS = 2048
MEMO_WORDS = 800_000
_FLUSH_BYTES = 4 << 20


class SumOfSquares:
    """Which fill level to put an item on so that the squared level counts stay smallest.

    ``counts[h]`` is the number of open windows filled to ``h``; empty and full windows do not
    count. Putting size s on level h moves one window from h to h + s.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)

    def place(self, size: int) -> int:
        """Level chosen for ``size`` (0: a new window); ties go to the fullest window."""
        here, there = self.counts[: self.capacity + 1 - size], self.counts[size:]
        growth = 2 * (there - here) + 2
        growth[0] -= 1  # a new window leaves no level
        growth[-1] -= 1  # a full window enters none
        growth[1:][here[1:] == 0] = np.iinfo(np.int64).max
        level = len(growth) - 1 - int(np.argmin(growth[::-1]))
        if level:
            self.counts[level] -= 1
        if level + size < self.capacity:
            self.counts[level + size] += 1
        return level


class Packer:
    """Windows of one task. A piece is (id, start, doc_tokens, ids as little-endian bytes)."""

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open = capacity, max_open
        self._reset()

    def _reset(self) -> None:
        self.levels = SumOfSquares(self.capacity)
        self.open: dict[int, list[list[tuple]]] = {}
        self.n_open = 0

    def add(self, doc_id, ids: bytes) -> Iterator[list[tuple]]:
        """Full windows that this document completes. Whole windows are cut off it first."""
        total, start = len(ids) // 4, 0
        while total - start >= self.capacity:
            stop = start + self.capacity
            yield [(doc_id, start, total, ids[4 * start : 4 * stop])]
            start = stop
        size = total - start
        if not size:
            return
        level = self.levels.place(size)
        window = self.open[level].pop() if level else []
        self.n_open += not level
        window.append((doc_id, start, total, ids[4 * start :]))
        if level + size == self.capacity:
            self.n_open -= 1
            yield window
        else:
            self.open.setdefault(level + size, []).append(window)
            if self.n_open > self.max_open:
                yield from self.pour(keep=True)

    def pour(self, keep: bool = False) -> Iterator[list[tuple]]:
        """Close all open windows, filling the fullest from the emptiest; the last one may stay
        partial, and with ``keep`` stays open then."""
        windows = [w for h in sorted(self.open, reverse=True) for w in self.open[h]]
        self._reset()
        first, last = 0, len(windows) - 1
        while first <= last:
            window = windows[first]
            fill = sum(len(piece[3]) for piece in window) // 4
            while fill < self.capacity and first < last:
                donor = windows[last]
                doc_id, start, total, ids = donor.pop()
                take = min(self.capacity - fill, len(ids) // 4)
                window.append((doc_id, start, total, ids[: 4 * take]))
                fill += take
                if 4 * take < len(ids):
                    donor.append((doc_id, start + take, total, ids[4 * take :]))
                if not donor:
                    last -= 1
            if keep and fill < self.capacity:
                self.levels.counts[fill] = self.n_open = 1
                self.open[fill] = [window]
            else:
                yield window
            first += 1


# Words on which Unicode normalisation and lower-casing change nothing, then plain punctuation.
_PLAIN_WORD = re.compile(r"([a-zß-öø-ÿ]+)([.,;:!?|]*)")


class WordIds:
    """Token ids of a text as bytes, word by word.

    Only for tokenizers that encode the parts between spaces and line ends apart from each
    other and drop the spaces (``splits_at_spaces`` tells); others encode whole texts. Each
    distinct word is encoded once and remembered.
    """

    def __init__(self, path: str, limit: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_word = splits_at_spaces(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        shown = byte_alphabet()
        self.shown = {b: c for c, b in shown.items()}
        self.direct = self.by_word and self._plain_words_match()
        self.lower = self.by_word and self._library("Ab CÉ") == self._library("ab cÉ")
        self.known = Memo(self._word, limit)

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _model(self, word: str) -> bytes:
        """Ids of a word that the normaliser and the split leave whole."""
        text = word if word.isascii() else "".join(map(self.shown.__getitem__, word.encode()))
        ids = [t.id for t in self.tokenizer.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain_words_match(self) -> bool:
        probe = ["the", "straße", "été", "zzyzxq", "mañana"]
        try:
            return all(self._model(w) + self.known_mark(m) == self._library(w + m) for w in probe for m in ("", ".", "!?", ",|"))
        except KeyError:
            return False

    def known_mark(self, marks: str) -> bytes:
        return self._library(marks) if marks else b""

    def _word(self, word: str) -> bytes:
        m = _PLAIN_WORD.fullmatch(word) if self.direct else None
        if m is None:
            return self._library(word) if word else b""
        return self._model(m[1]) + (self.known[m[2]] if m[2] else b"")

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4").tobytes() for e in found]
        return [self._text(t) for t in texts]

    def _text(self, text: str) -> bytes:
        if self.lower:
            lowered = text.encode().lower().decode()  # A-Z only
            if not any(t in lowered for t in self.added):
                text = lowered
        return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))


def splits_at_spaces(tokenizer) -> bool:
    """Whether spaces and line ends separate words and leave no trace in the ids."""
    probe = "ab cd\nef  gh \n ij. k,l 12 34 é ü"
    whole = tokenizer.encode(probe, add_special_tokens=False).ids
    words = [w for w in probe.replace("\n", " ").split(" ") if w]
    if whole != [i for w in words for i in tokenizer.encode(w, add_special_tokens=False).ids]:
        return False
    added = tokenizer.get_added_tokens_decoder().values()
    return all(" " not in t.content and not t.lstrip and not t.rstrip for t in added)


_ENCODERS: dict[tuple, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_open: int = MAX_OPEN_WINDOWS,
) -> DataFrame:
    """Pieces of all documents, packed into windows of at most ``capacity`` tokens.

    One row per piece: the id column, ``start`` (tokens of its document before it), ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and ``token_bytes``, the ids as
    little-endian unsigned 32-bit integers. ``tokenizer`` is the path of a ``tokenizers`` file;
    ``end_id`` is added to each document.

    Each task packs its own rows, so nothing is shuffled and no step depends on the number of
    documents. Whole windows are cut off long documents; the rest of each is placed by sum of
    squares. At the end of a task, or beyond ``max_open`` open windows, the fullest open windows
    are filled up from the emptiest, so that one window a task at most stays partial.
    ``sequence_id`` is the task's partition shifted by 33 bits plus a number, the same if a lost
    task runs again on the same input split.

    Null and empty texts have only ``end_id``. Null and repeated ids pass through, each row being
    a document of its own. Other columns are ignored, whatever their names. An empty table gives
    no rows.
    """
    if capacity < 2:
        raise ValueError("capacity must be at least 2")
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = source.schema["id"].dataType
    arrow_id = to_arrow_type(id_type)
    columns = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "token_bytes"]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(tokenizer), Packer(capacity, max_open)
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            types = [arrow_id, *[pa.int64()] * 5, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], columns)

        def windows() -> Iterator[list[tuple]]:
            for part in text_slices(batches):
                ids = part.column("id").to_pylist()
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, tokens in zip(ids, encoder.encode(texts)):
                    yield from packer.add(doc_id, tokens + end)
            yield from packer.pour()

        for window in windows():
            offset = 0
            for doc_id, start, total, tokens in window:
                length = len(tokens) // 4
                rows.append((doc_id, start, length, total, number, offset, tokens))
                offset += length
                held += len(tokens)
            number += 1
            if held >= _FLUSH_BYTES:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    schema = (
        f"id {id_type.simpleString()}, start long, length long, doc_tokens long, "
        "sequence_id long, offset long, token_bytes binary"
    )
    packed = source.mapInArrow(run, schema)
    return packed.withColumnRenamed("id", id_col)
