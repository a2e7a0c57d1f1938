import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import hamming_search


def plain(rows, k):
    out = []
    for i, (q, a) in enumerate(rows):
        if q % 20 == 0:
            near = sorted((bin((a ^ b) & (2 ** 64 - 1)).count("1"), j) for j, b in rows)[:k]
            out += [(q, r + 1, j, d) for r, (d, j) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(10_000, 4, 10_000), (37, 8, 200)])
def test_search_equals_all_pairs(spark, sizes):
    rng = np.random.default_rng(1)
    codes = rng.integers(-2 ** 63, 2 ** 63 - 1, 400)
    codes[100:250] = 7          # one code for a third of the rows
    codes[250:300] = 7 ^ (1 << rng.integers(0, 60, 50))
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(40, 7), (60, 7)]
    frame = spark.createDataFrame(rows, "id long, code long")
    got = hamming_search.top_k(frame, F.col("id") % 20 == 0, 10, sizes, sizes)
    assert sorted(map(tuple, got.collect())) == plain(rows, 10)


def test_few_rows_and_none(spark):
    frame = spark.createDataFrame([(0, 1), (1, 3), (20, 1)], "id long, code long")
    got = hamming_search.top_k(frame, F.col("id") % 20 == 0, 10)
    assert sorted(map(tuple, got.collect())) == plain([(0, 1), (1, 3), (20, 1)], 10)
    assert hamming_search.top_k(frame.where("false"), F.col("id") % 20 == 0).count() == 0


def test_codes(spark):
    vectors = [(1, [0.5, -1.0, 0.0, 2.0], 3), (2, None, 0), (None, [1.0], 0), (3, [], 0),
               (4, [None, float("nan"), 1.0], 0), (5, [1.0] * 64, 0), (1, [0.5], 1)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, code int")
    got = sorted(map(tuple, hamming_search.sign_codes(frame, "vec_id", "embedding").collect()))
    assert got == [(1, 1), (1, 9), (3, 0), (4, 4), (5, -1)]
    long = spark.createDataFrame([(1, [1.0] * 65)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="more than 64"):
        hamming_search.sign_codes(long, "vec_id", "embedding").collect()
