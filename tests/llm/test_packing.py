import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clearledger.llm import packing
from clearledger.llm.packing import SumOfSquares, WordIds, pack
from clearledger.llm.queries import pack_digest

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_place_minimises_the_sum_of_squares():
    rng, packer = random.Random(1), SumOfSquares(64)
    counts = [0] * 65
    for _ in range(3000):
        size = rng.choice([1, 7, 20, 33, 40, 63])
        costs = {}
        for level in range(65 - size):
            if level == 0 or counts[level]:
                after = counts.copy()
                if level:
                    after[level] -= 1
                if level + size < 64:
                    after[level + size] += 1
                costs[level] = sum(c * c for c in after)
        level = packer.place(size)
        assert costs[level] == min(costs.values())
        assert level == max(k for k, v in costs.items() if v == costs[level])
        counts[level] -= bool(level)
        counts[level + size] += level + size < 64
        assert packer.counts.tolist() == counts


def check(pieces, texts, library, capacity):
    """Every id in one piece, sequences gapless and full but for one a task."""
    got, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.token_bytes, dtype="<u4").tolist()
        assert len(ids) == p.length > 0
        got[p.doc_id].append((p.start, p.doc_tokens, ids))
        sequences[p.sequence_id].append((p.offset, p.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, copies in texts.items():
        want = sorted([*library.encode(t or "", add_special_tokens=False).ids, 2] for t in copies)
        starts = sorted(got[doc_id])
        if len(copies) == 1:
            assert sum((s[2] for s in starts), []) == want[0]
            assert all(s[1] == len(want[0]) for s in starts)
        assert sum(len(s[2]) for s in starts) == sum(map(len, want))
    return [sum(n for _, n in s) for s in sequences.values()]


def by_id(rows):
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r.text)
    return found


@pytest.mark.parametrize("max_open", [2, packing.MAX_OPEN_WINDOWS])
def test_pack_loses_and_repeats_nothing(spark, docs, library, max_open):
    rng = random.Random(2)
    df = docs([(i, " ".join(rng.choices(["the", "idea", "straße", "x9", "l'été,"], k=rng.choice([0, 3, 40, 90, 400])))) for i in range(300)])
    df = df.coalesce(1)
    fills = check(pack(df, PATH, 2, 256, max_open=max_open).collect(), by_id(df.collect()), library, 256)
    assert sum(f < 256 for f in fills) <= 1


def test_pack_odd_rows(odd, nothing, library):
    check(pack(odd, PATH, 2, 128).collect(), by_id(odd.collect()), library, 128)
    assert pack(nothing, PATH, 2).count() == 0
    assert pack_digest(pack(odd, PATH, 2)).columns[:6] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]


def test_word_ids_equal_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abctTHEin'  \n.,sdréÉİ́漢🙂0½<|>", k=50)) for _ in range(2000)]
    texts += ["a <|endoftext|> b", "x<|ENDOFTEXT|>y", "é É", "word word x"]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert WordIds(PATH, limit=100).encode(texts) == want


def test_byte_level_files_are_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    made, library = WordIds(path), Tokenizer.from_file(path)
    assert not made.by_word
    assert made.encode(["two  spaces\n x"]) == [np.array(library.encode("two  spaces\n x").ids, dtype="<u4").tobytes()]


def test_too_small_a_window_is_refused(odd):
    with pytest.raises(ValueError, match="capacity"):
        pack(odd, PATH, 2, 1)
