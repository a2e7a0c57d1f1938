import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import hard_negatives
from tallyfold.llm.queries import ORACLES, QUERIES
from verification.compare import connect

KIND = "vec_id long, embedding array<double>, label int"


def takes_part(row):
    return None not in row and all(x is not None and math.isfinite(x) for x in row[1])


def plain(rows, every=100, n_positives=5, n_negatives=10):
    rows = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in filter(takes_part, rows)]
    out = []
    for at, (anchor, v, label) in enumerate(rows):
        if anchor % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, c)
                  for k, (i, w, c) in enumerate(rows) if k != at]
        for p, positive, _ in sorted(s for s in scores if s[2] == label)[:n_positives]:
            far = sorted(s for s in scores if s[2] != label and -30 * p <= -100 * s[0] <= -90 * p)
            out += [(anchor, positive, rank + 1, i, -p, -s)
                    for rank, (s, i, _) in enumerate(far[:n_negatives])]
    return sorted(out)


def check(spark, rows, every, **options):
    frame = spark.createDataFrame(rows, KIND).repartition(3)
    got = hard_negatives.hard_negatives(frame, F.col("id") % every == 0, **options).collect()
    want = plain(rows, every)
    assert sorted(map(tuple, got)) == want
    return want


def vectors(seed, n, size, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (4, size))
    labels = rng.integers(0, 4, n)
    return [(i, (centres[c] + rng.normal(0, 0.3, size)).tolist(), int(rng.integers(0, 4)) if i % 5
             == 0 else int(c)) for i, c in enumerate(labels)]


@pytest.mark.parametrize("size,spread", [(64, 0.2), (1, 1.0), (7, 0.5), (33, 1.0)])
def test_mining_equals_all_pairs(spark, size, spread):
    rows = vectors(size, 300, size, spread)
    rows[100:200] = [(i, rows[100][1], c) for i, _, c in rows[100:200]]  # a third are one vector
    assert check(spark, rows, 20)


def test_results_do_not_depend_on_cells(spark):
    rows = vectors(3, 120, 16, 0.6)
    check(spark, rows, 5, shard_sizes=(10, 4, 10), block_sizes=(3, 4, 5))


def test_awkward_rows(spark):
    rows = vectors(2, 60, 8, 0.7) + [
        (100, None, 1), (101, [1.0] * 8, None), (None, [1.0] * 8, 1), (102, [float("nan")] * 8, 2),
        (103, [float("inf")] + [0.0] * 7, 0), (104, [None] + [0.0] * 7, 0), (105, [], 1),
        (106, [1.0], 1), (110, [0.0] * 8, 2), (120, [-1.0] * 8, 3), (20, [0.5] * 8, 1)]
    frame = spark.createDataFrame(rows, KIND).selectExpr(
        "*", "1 AS id", "'x' AS row", "2 AS rank", "0 AS scores", "0 AS means")
    got = hard_negatives.hard_negatives(frame, F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    padded = [(i, v if v is None else v + [0.0] * (8 - len(v)), c) for i, v, c in rows]
    assert sorted(map(tuple, got.collect())) == plain(padded, 10)
    for none in (frame.limit(0), frame.where("vec_id = 105"), frame.where("vec_id = 10")):
        assert hard_negatives.hard_negatives(none, F.col("id") % 10 == 0).count() == 0


@pytest.mark.parametrize("size", [1, 4, 9, 64, 100])
def test_bounds_hold_and_narrow(size):
    rng = np.random.default_rng(size)
    rows = np.floor(rng.normal(0, 200, (50, size)))
    means, deviations = hard_negatives.summaries(rows)
    exact, at, width = rows @ rows.T, 0, np.inf
    for starts in hard_negatives.levels(size):
        part = slice(at, at + len(starts))
        at = part.stop
        middle, apart = means[:, part] @ means[:, part].T, deviations[:, part] @ deviations[:, part].T
        assert (np.abs(exact - middle) <= apart + hard_negatives.SLACK).all()
        assert apart.sum() <= width + 1e-6
        width = apart.sum()
    assert at == means.shape[1]


def test_rows_are_left_out_before_they_are_scored(spark, monkeypatch):
    """With well-separated segment means most rows never reach the exact score."""
    rng = np.random.default_rng(0)
    rows = [(i, np.repeat(rng.normal(0, 1, 8), 8) + rng.normal(0, 0.02, 64), i % 3)
            for i in range(600)]
    import pyarrow as pa

    whole = np.floor(256 * np.array([v for _, v, _ in rows]))
    means, deviations = hard_negatives.summaries(whole)
    lists = [hard_negatives._lists(part) for part in (whole, means, deviations)]
    table = pa.table({"row": range(600), "id": range(600), "label": [str(c) for _, _, c in rows],
                      "vector": lists[0], "means": lists[1], "deviations": lists[2]})
    shard = hard_negatives.Rows(table)
    scored = []
    score = shard.score
    shard.score = lambda which, other, at: scored.append(len(which)) or score(which, other, at)
    for at in range(20):
        hard_negatives.positives(shard, shard, at, 5)
    assert sum(scored) < 20 * 200 * 0.3


def table_of(rows):
    """A cell's rows, as the operator deals them."""
    import pyarrow as pa

    whole = np.floor(256 * np.array([v for _, v, _ in rows]))
    lists = [hard_negatives._lists(part) for part in (whole, *hard_negatives.summaries(whole))]
    return pa.table({"row": range(len(rows)), "id": [i for i, _, _ in rows],
                     "label": [str(c) for _, _, c in rows], "vector": lists[0], "means": lists[1],
                     "deviations": lists[2]})


def test_anchors_of_a_cell_are_searched_together(monkeypatch):
    """Products of a tile with many anchors, not passes over the rows for each anchor and range."""
    rng = np.random.default_rng(5)
    cell = hard_negatives.Rows(table_of(
        [(i, rng.normal(0, 0.125, 64), int(rng.integers(0, 10))) for i in range(1_000)]))
    calls, score, bounds = [], hard_negatives.Rows.score, hard_negatives.Rows.bounds
    monkeypatch.setattr(hard_negatives.Rows, "score",
                        lambda *given: calls.append(given) or score(*given))
    monkeypatch.setattr(hard_negatives.Rows, "bounds",
                        lambda *given: calls.append(given) or bounds(*given))
    hard_negatives.positives(cell, cell, np.arange(1_000), 5)
    assert len(calls) < 1_000
    calls.clear()
    found = hard_negatives.negatives(cell, cell, [[(0, 6_000), (3_000, 9_000)]] * 1_000, 10)
    assert len(calls) < 1_000 and len(found[0]) == 20_000


def test_rows_are_copied_once_for_thousands_of_anchors(spark):
    rows = spark.range(20).select(F.col("id").alias("row"))
    anchors = spark.range(4_000).select(F.col("id").alias("row"), F.lit(None).cast(
        "array<bigint>").alias("scores"))
    cells = hard_negatives._cells(rows, anchors, hard_negatives.SHARDS, hard_negatives.BLOCKS)
    assert sum(r["count"] for r in cells.count().collect()) == 4_020


@pytest.mark.parametrize("order", ["mixed", "rising", "falling", "copies"])
def test_tiles_give_the_first_rows_and_ties_by_id(monkeypatch, order):
    """More rows than a tile, more anchors than a group, in any order of scores; ranges without rows."""
    monkeypatch.setattr(hard_negatives, "GROUP", 7)
    monkeypatch.setattr(hard_negatives, "FEW", 2)
    monkeypatch.setattr(hard_negatives, "TILES", (4, 32))
    rng = np.random.default_rng(6)
    lengths = {"mixed": rng.permutation(300), "rising": np.arange(300),
               "falling": np.arange(300)[::-1], "copies": rng.integers(0, 3, 300)}[order]
    rows = [(i, np.full(8, (1 + n) / 64), int(rng.integers(0, 3))) for i, n in enumerate(lengths)]
    shard, anchors = hard_negatives.Rows(table_of(rows)), hard_negatives.Rows(table_of(
        [(i, v, c) for i, v, c in rows[::10]] + [(400, np.ones(8), 9)]))  # a label of no row
    exact = np.array([anchors.vector[a] @ shard.vector.T for a in range(31)]).astype(np.int64)
    same = np.array([[c == d for _, _, d in rows] for _, _, c in [*rows[::10], (0, 0, 9)]])
    got = sorted(zip(*(x.tolist() for x in hard_negatives.positives(
        shard, anchors, np.arange(31), 5))))
    want, ranges = [], []
    for a in range(31):
        others = [i for i in range(300) if same[a, i] and i != anchors.row[a]]
        want += [(a, i, exact[a, i]) for i in sorted(others, key=lambda i: (-exact[a, i], i))[:5]]
        top = int(exact[a].max())
        ranges.append([(top // 4, top // 2), (top // 3, top - 1), (9, 3), (-5, 10 * top)][:a % 5])
    assert got == sorted(want)
    got = sorted(zip(*(x.tolist() for x in hard_negatives.negatives(shard, anchors, ranges, 10))))
    want = [(a, n, i, exact[a, i]) for a in range(31) for n, (low, high) in enumerate(ranges[a])
            for i in sorted((i for i in range(300) if not same[a, i] and low <= exact[a, i] <= high),
                            key=lambda i: (-exact[a, i], i))[:10]]
    assert got == sorted(want) and want


def test_query_equals_its_sql(spark):
    sf_dir, name = "/root/testdata/sf0.001", "op13_hard_negatives"
    got = QUERIES[name](spark, sf_dir)
    result = connect(sf_dir).execute(ORACLES[name])
    assert got.columns == [d[0] for d in result.description]
    want = result.fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
