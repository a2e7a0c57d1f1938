import math
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.tails import (
    exact_rank_sum_p, normal_sf, rank_sum_cdf, student_t_two_sided)


def test_normal_tail_against_erfc(spark):
    zs = [0.0, 1e-6, 0.3, 1.05, 1.0607, 1.07, 2.0, 5.0, 9.0, 20.0, 37.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal_sf("z"))
    for z, p in rows.collect():
        assert p == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), rel=1e-13)


def test_normal_tail_of_negative_and_null(spark):
    rows = spark.createDataFrame([(-1.5,), (None,)], "z double").select(normal_sf("z")).collect()
    assert rows[0][0] == pytest.approx(1 - 0.5 * math.erfc(1.5 / math.sqrt(2)), rel=1e-14)
    assert rows[1][0] is None


def closed_form(t, df):
    if df == 1:
        return 2 / math.pi * math.atan2(1, t)
    if df == 2:
        return 2 / (t * t + 2 + t * math.sqrt(t * t + 2))
    if df == 4:
        x = t / math.sqrt(4 + t * t)
        return 1 - 1.5 * x + 0.5 * x ** 3
    return math.erfc(t / math.sqrt(2))


@pytest.mark.parametrize("df,ts,rel", [
    (1, [0.0, 0.001, 0.7, 3.0, 40.0, 1e4], 1e-13),
    (2, [0.0, 0.001, 0.7, 3.0, 40.0, 1e4], 1e-13),
    (4, [0.0, 0.5, 2.0, 5.0], 1e-12),
    (1e12, [0.0, 0.5, 2.0, 5.0], 1e-8),
])
def test_t_tail_against_closed_forms(spark, df, ts, rel):
    rows = spark.createDataFrame([(t, float(df)) for t in ts], "t double, df double")
    for t, p in rows.select("t", student_t_two_sided("t", "df")).collect():
        assert p == pytest.approx(closed_form(t, df), rel=rel)


def test_t_tail_is_even_and_handles_limits(spark):
    rows = [(2.5, 7.3), (-2.5, 7.3), (float("inf"), 3.0), (float("-inf"), 3.0), (None, 3.0),
            (1.0, None)]
    out = [r[0] for r in spark.createDataFrame(rows, "t double, df double")
           .select(student_t_two_sided("t", "df")).collect()]
    assert out[0] == out[1] and out[2] == out[3] == 0.0 and out[4] is None and out[5] is None


def test_t_tail_lies_between_neighbouring_whole_df(spark):
    rows = [(2.0, 1.0), (2.0, 1.5), (2.0, 2.0)]
    p = [r[0] for r in spark.createDataFrame(rows, "t double, df double")
         .select(student_t_two_sided("t", "df")).collect()]
    assert p[0] > p[1] > p[2]


@pytest.mark.parametrize("n1,n2", [(1, 1), (1, 6), (3, 3), (3, 5), (8, 8), (5, 9)])
def test_exact_rank_distribution_against_enumeration(n1, n2):
    seen = Counter(sum(c) - n1 * (n1 - 1) // 2 for c in combinations(range(n1 + n2), n1))
    total, so_far, numerators = sum(seen.values()), 0, {}
    for u in range(n1 * n2 + 1):
        so_far += seen[u]
        assert rank_sum_cdf(u, n1, n2, numerators) == pytest.approx(so_far / total, rel=1e-15)


def test_exact_rank_distribution_of_a_huge_group():
    assert rank_sum_cdf(4 * 10 ** 9, 8, 10 ** 9) == pytest.approx(0.5, abs=1e-6)
    assert rank_sum_cdf(0, 2, 10 ** 9) == pytest.approx(2 / (10 ** 9 + 2) / (10 ** 9 + 1), rel=1e-12)


def test_exact_p_as_column(spark):
    rows = spark.createDataFrame([(0.0, 3, 3), (None, 3, 3), (4.5, 3, 3)],
                                 "u double, a bigint, b bigint")
    p = [r[0] for r in rows.select(exact_rank_sum_p(F.col("u"), F.col("a"), F.col("b"))).collect()]
    assert p[0] == pytest.approx(0.1) and p[1] is None and p[2] == 1.0
