import math
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tallyfold.llm import lattice_lm
from tallyfold.llm.queries import PIECE_MODEL, QUERIES
from tests.llm.samples import AWKWARD, documents, no_documents, texts

MODEL = open(PIECE_MODEL, "rb").read()


@pytest.fixture(scope="module")
def lattice():
    return lattice_lm.Lattice(MODEL)


def segmentations(library, word):
    """Every way to write the word (with its space mark), as lists of piece ids."""
    if not word:
        return [[]]
    out = []
    for k in range(1, len(word) + 1):
        i = library.piece_to_id(word[:k])
        if library.id_to_piece(i) == word[:k] and not library.is_byte(i):
            out += [[i, *rest] for rest in segmentations(library, word[k:])]
        elif k == 1:
            spelt = [library.piece_to_id(f"<0x{b:02X}>") for b in word[0].encode()]
            out += [[*spelt, *rest] for rest in segmentations(library, word[1:])]
    return out


def test_sums_equal_all_segmentations(lattice):
    library = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    log_p = np.log(np.maximum(lattice.prior, 1e-300))
    words = ["the", "thing", "a", "ab\x01c", "▁x", "😀é", "𝔘", "sta"]
    counts = np.arange(1.0, len(words) + 1)
    got, _ = lattice.forward(words, log_p)
    expected = np.zeros(lattice.size + 1)
    for word, value, n in zip(words, got, counts):
        ways = segmentations(library, "▁" + word)
        chances = [math.exp(sum(log_p[i] for i in way)) for way in ways]
        assert value == pytest.approx(math.log(sum(chances)), rel=1e-9)
        for way, chance in zip(ways, chances):
            np.add.at(expected, way, n * chance / sum(chances))
    assert lattice.expected(words, counts, log_p) == pytest.approx(expected, abs=1e-9)
    assert lattice.prior.sum() == pytest.approx(1.0)


def plain_base(docs):
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in docs}
    words = [(d, lattice_lm.words_of(t or "")) for d, t in docs]
    count = Counter()
    for d, w in words:
        if not held[d]:
            count.update([*w, None])
    n, v = sum(count.values()), len(count)
    return [(d, held[d], len(w) + 1, sum(count[x] > 0 for x in [*w, None]), n,
             sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*w, None])) for d, w in words]


@pytest.mark.parametrize("frequent", [100_000, 20])
def test_base_model_and_scores(spark, frequent):
    frame = documents(spark, AWKWARD)
    rows = lattice_lm.scores(frame, PIECE_MODEL, frequent=frequent).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    want = sorted(plain_base([(r.doc_id, r.text) for r in frame.collect()]), key=key)
    for got, plain in zip(sorted(map(tuple, rows), key=key), want, strict=True):
        assert got[:5] == plain[:5]
        assert got[5] == pytest.approx(plain[5], rel=1e-9) and got[6] < 0
    empty = {r.score for r in rows if r.n_tokens == 1}
    assert len(empty) == 1
    assert lattice_lm.scores(no_documents(spark), PIECE_MODEL).count() == 0


def test_query_equals_brute_force_and_predicts(spark):
    sf_dir = "/root/testdata/sf0.001"
    given = texts(sf_dir)
    got = {r.doc_id: r for r in QUERIES["op5_lattice_lm"](spark, sf_dir).collect()}
    for d, held, n, known, total, base in plain_base(given):
        row = got[d]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held, n, known, total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
    # held-out rows: better than the vocabulary's prior alone, which saw no training text
    with np.errstate(divide="ignore"):
        model = lattice_lm.Lattice(MODEL)
        prior = np.log(model.prior)
    held = [(d, t) for d, t in given if got[d].held_out and (t or "").split()]
    before = sum(model.forward(lattice_lm.words_of(t), prior)[0].sum() / np.log(10)
                 for _, t in held)
    assert sum(got[d].score for d, _ in held) > 0.95 * before


def test_reweighting_raises_the_likelihood_of_training_texts(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sums = [lattice_lm.scores(frame, PIECE_MODEL, rounds=n).where("NOT held_out").agg(
        {"score": "sum"}).first()[0] for n in (0, 1, 2)]
    assert sums == sorted(sums)
