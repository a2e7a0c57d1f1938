import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from tallyfold.llm import sentencepiece_codec
from tallyfold.llm.queries import PIECE_MODEL, QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents, texts

MODEL = open(PIECE_MODEL, "rb").read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def plain(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())


@pytest.mark.parametrize("cached", [100_000, 3])
def test_ids_equal_the_library(library, cached):
    encoder = sentencepiece_codec.BacktrackingEncoder(MODEL, cached, cached)
    rng = random.Random(7)
    alphabet = "  ▁▁\n\tabcthe ing<s></s><0x0A>日本語éß😀\0́​xyzTHE...,,,aaaa"
    given = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(3000)]
    given += [t or "" for t in AWKWARD] + [" " * 100, "ab" * 3000, "aaaaaaaaab" * 300, "�"]
    for text in given:
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
        assert encoder.decode(ids) == library.decode(ids.tolist())


def test_awkward_rows(spark, library):
    frame = documents(spark, AWKWARD)
    got = sentencepiece_codec.encode_and_decode(frame, PIECE_MODEL, keep_ids=True)
    assert got.columns == [*frame.columns, "codec_"]
    for row in got.collect():
        assert (row.codec_.n_tokens, row.codec_.ids_sha256, row.codec_.decoded_sha256) == plain(
            library, row.text)
        assert row.codec_.ids == library.encode(row.text or "", add_bos=True, add_eos=True)
    assert sentencepiece_codec.encode_and_decode(no_documents(spark), PIECE_MODEL).count() == 0


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_sentencepiece"](spark, sf_dir).collect()}
    assert got == {d: plain(library, t) for d, t in texts(sf_dir)}
