"""Parallel numbering / running sums / quantiles / AUC against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators import evaluate as EV
from tarmac.operators.numbering import exact_quantiles, global_row_number, prefix_sums


def hot_key_rows(n=3000, seed=7):
    """A third of the rows share one date (the hot key); ties broken by other columns."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        day = 5 if i % 3 == 0 else rnd.randint(0, 30)
        rows.append((day, rnd.choice("ABCDE"), rnd.randint(0, 50), float(rnd.randint(-20, 80))))
    return rows


def test_global_row_number_equals_single_window(spark):
    df = spark.createDataFrame(hot_key_rows(), "d int, a string, k int, v double")
    order = ["d", "a", "k", "v"]
    got = global_row_number(df, order, partitions=7)
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    want = df.withColumn("rn", F.row_number().over(w))  # single task: brute force on small data
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # numbers are exactly 1..n
    stats = got.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()
    assert tuple(stats) == (1, 3000, 3000)


def test_global_row_number_with_adaptive_range_sizes(spark):
    """No explicit partition count: AQE merges neighbouring ranges; numbers stay exact."""
    df = spark.createDataFrame(hot_key_rows(4000, seed=9), "d int, a string, k int, v double")
    order = ["d", "a", "k", "v"]
    got = global_row_number(df, order)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_key_is_split_across_range_partitions(spark):
    df = spark.createDataFrame(hot_key_rows(), "d int, a string, k int, v double")
    ranged = df.repartitionByRange(8, "d", "a", "k", "v")
    per_part = ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in per_part) < 1000  # the 1000-row hot date is not one task


def test_prefix_sums_match_cumsum(spark):
    rnd = random.Random(3)
    rows = [(float(x), rnd.randint(0, 9), rnd.randint(0, 9)) for x in rnd.sample(range(100000), 2000)]
    df = spark.createDataFrame(rows, "key double, a long, b long")
    got = {r["key"]: (r["cum_a"], r["cum_b"], r["total_a"]) for r in
           prefix_sums(df, "key", ["a", "b"], partitions=13).collect()}
    rows.sort()
    ca = np.cumsum([r[1] for r in rows])
    cb = np.cumsum([r[2] for r in rows])
    for (k, _, _), x, y in zip(rows, ca, cb):
        assert got[k][:2] == (x, y)
        assert got[k][2] == ca[-1]
    desc = {r["key"]: r["cum_a"] for r in prefix_sums(df, "key", ["a"], descending=True,
                                                       inclusive=False, partitions=5).collect()}
    rows.sort(reverse=True)
    before = np.concatenate([[0], np.cumsum([r[1] for r in rows])[:-1]])
    assert all(desc[k] == b for (k, _, _), b in zip(rows, before))


@pytest.mark.parametrize("values", [
    [5.0] * 1000 + [1.0, 2.0, 3.0],  # one value holds almost all rows
    [float(x) for x in range(1, 1002)],
    [float(x % 17) for x in range(777)],
])
def test_exact_quantiles_are_percentile_disc(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = exact_quantiles(df, "x", probs).first()
    s = sorted(values)
    n = len(s)
    for p, g in zip(probs, got):
        idx = max(0, int(np.ceil(p * n)) - 1)  # smallest value with cumulative share >= p
        assert g == s[idx]
    builtin = df.agg(*[F.expr(f"percentile_disc({p}) within group (order by x)") for p in probs]).first()
    assert tuple(got) == tuple(builtin)


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_exact_auc_and_roc_brute_force(spark):
    rnd = random.Random(11)
    pairs = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "score double, y int")
    got = EV.exact_auc(df, "y", "score").first()
    assert abs(got["auc"] - brute_auc(pairs)) < 1e-12
    roc = EV.roc_curve(df, "y", "score").collect()
    npos = sum(y for _, y in pairs)
    nneg = len(pairs) - npos
    for r in roc[1:]:
        t = r["threshold"]
        assert r["tpr"] == sum(1 for s, y in pairs if s >= t and y == 1) / npos
        assert r["fpr"] == sum(1 for s, y in pairs if s >= t and y == 0) / nneg
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (0.0, 0.0) and (roc[-1]["fpr"], roc[-1]["tpr"]) == (1.0, 1.0)


def test_regression_metrics(spark):
    pairs = [(float(i % 13), float(i % 13) + (i % 3) - 1) for i in range(500)]
    df = spark.createDataFrame(pairs, "y double, p double")
    got = EV.regression_metrics(df, "y", "p").first()
    y = np.array([a for a, _ in pairs])
    p = np.array([b for _, b in pairs])
    assert abs(got["rmse"] - round(float(np.sqrt(np.mean((y - p) ** 2))), 6)) < 1e-9
    assert abs(got["r2"] - round(float(1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)), 6)) < 1e-9


@pytest.mark.parametrize("limit", [1, 7, 250, 5000])
def test_bounded_sample_is_exact_top_k_by_hash(spark, limit):
    import hashlib

    rows = [(i % 997, f"k{i % 13}") for i in range(3000)] + [(5, "hot")] * 1500  # a third are copies
    df = spark.createDataFrame(rows, "a int, b string")
    from tarmac.operators.sampling import bounded_sample

    got = sorted(tuple(r) for r in bounded_sample(df, limit, ["a", "b"]).collect())

    def key(r):
        return (hashlib.md5(f"{r[0]}|{r[1]}".encode()).hexdigest(), r[0], r[1])

    want = sorted(sorted(rows, key=key)[:limit])
    assert got == want


def test_distribution_summary_against_numpy(spark):
    from tarmac.operators.summaries import distribution_summary

    rnd = random.Random(5)
    values = [1e9 + rnd.random() for _ in range(3000)] + [1e9 + 0.5] * 1000  # large mean, hot value
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.summary: r.x for r in distribution_summary(df, "x").collect()}
    a = np.array(values)
    assert got["count"] == len(values)
    assert abs(got["mean"] - a.mean()) <= 1e-14 * abs(a.mean()) + 1e-6  # ulp(1e9) ~ 1e-7, plus rounding
    assert abs(got["stddev"] - a.std(ddof=1)) < 1e-6
    assert got["min"] == a.min() and got["max"] == a.max()
    s = sorted(values)
    for p, k in ((0.25, "25%"), (0.5, "50%"), (0.75, "75%")):
        assert got[k] == s[max(0, int(np.ceil(p * len(s))) - 1)]
