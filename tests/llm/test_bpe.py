import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clearledger.llm.bpe import Decoder, Encoder, decode, encode, round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


def test_random_texts_encode_as_in_the_library(library, encoder):
    rng = random.Random(4)
    common = ["".join(rng.choices("abct hein   '\n.,sdré  \x1f\x85 漢🙂0½", k=rng.randint(1, 60))) for _ in range(3000)]
    rare = ["".join(chr(rng.choice([rng.randint(1, 0x2FFF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(30)) for _ in range(300)]
    texts = [*common, *rare, "", "a" * 5000, "a<|endoftext|> b<|endoftext|>", "it's they'LL  don't", "x\n", "x \n", " x"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == want.ids, repr(text)


def test_single_pieces_match_plain_merging(encoder):
    """The backtracking result against merging by rank, for runs of random tokens."""
    rng = random.Random(5)
    v = encoder.vocabulary
    tokens = [t for t in v.id_of if len(t) > 1]
    for _ in range(2000):
        piece = b"".join(rng.choices(tokens, k=3))
        parts = [v.id_of[bytes([b])] for b in piece]
        while True:
            ranks = [(v.merge_of[p][0], k) for k, p in enumerate(zip(parts, parts[1:])) if p in v.merge_of]
            if not ranks:
                break
            k = min(ranks)[1]
            parts[k : k + 2] = [v.merge_of[parts[k], parts[k + 1]][1]]
        assert encoder.tokens(piece) == parts


def test_decoding_follows_the_library(library, encoder):
    decoder, rng = Decoder(PATH), random.Random(6)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 20))]
        assert decoder.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_odd_rows_round_trip(odd, nothing):
    both = round_trip(odd, PATH).select("doc_id", "ids", "text").collect()
    want = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert sorted((str(r.doc_id), r.text) for r in both) == want
    apart = decode(encode(odd, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in apart) == want
    assert round_trip(nothing, PATH).count() == 0
    assert decode(odd.select("doc_id", F.lit(None).cast("array<int>").alias("ids")), PATH).filter("text is not null").count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        Encoder(public_tokenizers.path("word_bpe_49k.json"))
