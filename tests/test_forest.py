"""Forests grown in blocks: the trees of Spark's own estimator wherever no draw is random."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tarmac.operators import forest as FO
from tarmac.plans import ml as ML


def _rows(spark, n=3000):
    """Integer labels (sums are exact), two categoricals with a NULL, a feature without any spread, ties."""
    rows = spark.range(n).selectExpr(
        "id", "if(id % 97 = 0, null, concat('A', (id * 31) % 9)) airline", "concat('O', (id * 17) % 7) origin", "concat('D', (id * 13) % 4) dest",
        "concat('W', id % 2) day_of_week", "double((id * 7919) % 61) dep_delay", "double((id * 104729) % 997) distance", "int(id % 12) month", "2000 year")
    return rows.selectExpr("*", "dep_delay + (id * 31) % 9 * 3 + (id * 5) % 4 arr_delay").drop("id").repartition(3)


def _prepared(spark, task, algo, **settings):
    spec = ML.ModelSpec(task, algo)
    train = ML.prepare(_rows(spark), spec)
    (*features, forest), _ = ML.build_pipeline(spec)[0].getStages(), None
    forest = forest.copy().setParams(**settings)
    return forest, Pipeline(stages=features).fit(train).transform(train), features[-1].getInputCols()


def _trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


@pytest.mark.parametrize("task, algo", [("regress", "rfreg"), ("classify", "rf")])
def test_trees_without_random_draws_are_sparks_own(spark, task, algo, monkeypatch):
    monkeypatch.setattr(FO, "BLOCK_ROWS", 300)
    forest, rows, inputs = _prepared(spark, task, algo, numTrees=2, bootstrap=False, featureSubsetStrategy="all")
    own, sparks = FO.fit(forest, rows, inputs), forest.fit(rows)
    assert _trees(own) == _trees(sparks) and type(own) is type(sparks)
    assert np.allclose(own.featureImportances.toArray(), sparks.featureImportances.toArray())
    ours, theirs = ([tuple(r) for r in m.transform(rows).select("prediction").collect()] for m in (own, sparks))
    assert ours == theirs
    if task == "classify":
        pairs = own.transform(rows).select("features", "probability").collect()
        assert pairs == sparks.transform(rows).select("features", "probability").collect()


def test_a_level_in_several_passes_gives_the_same_trees(spark):
    settings = dict(numTrees=3, maxDepth=4, seed=7)
    forest, rows, inputs = _prepared(spark, "regress", "rfreg", **settings)
    whole = FO.fit(forest, rows, inputs)
    law_bytes = []
    real = FO.grow

    def narrow(blocks, law, max_bytes):
        law_bytes.append(max_bytes)
        return real(blocks, law, 30_000)

    FO.grow, kept = narrow, FO.grow
    try:
        again = FO.fit(forest, rows, inputs)
    finally:
        FO.grow = kept
    assert _trees(whole) == _trees(again) and law_bytes == [256 << 20]
    assert len({t for t in _trees(whole)}) == 3  # every tree has draws of its own


def test_a_bootstrapped_forest_predicts_as_well_as_sparks(spark):
    forest, rows, inputs = _prepared(spark, "regress", "rfreg", numTrees=40)
    r2 = RegressionEvaluator(labelCol="arr_delay", metricName="r2")
    own, sparks = (r2.evaluate(m.transform(rows)) for m in (FO.fit(forest, rows, inputs), forest.fit(rows)))
    assert own > 0.5 and abs(own - sparks) < 0.03


def test_bootstrap_counts_are_poisson_and_repeat():
    counts = FO.drawn(42, 3, 5, 400_000)
    assert np.array_equal(counts, FO.drawn(42, 3, 5, 400_000)) and not np.array_equal(counts, FO.drawn(42, 3, 6, 400_000))
    assert abs(counts.mean() - 1) < 0.01 and abs(counts.var() - 1) < 0.02
    assert abs((counts == 0).mean() - np.exp(-1)) < 0.004


def test_more_values_than_bins_are_cut_at_quantiles(spark):
    rows = spark.range(10_000).select((F.pow(F.col("id"), 2)).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("few"))
    wide, few = FO.find_bins(rows, ["x", "few"], 50)
    counts = np.bincount(np.searchsorted(wide.thresholds, np.arange(10_000.0) ** 2), minlength=wide.n)
    assert wide.n == 50 and counts.min() >= 180 and counts.max() <= 220
    assert few.thresholds == (0.5, 1.5, 2.5, 3.5)


def test_large_tables_take_the_blocks(spark, monkeypatch):
    taken, real = [], FO.fit
    monkeypatch.setattr(FO, "fit", lambda *a: taken.append(1) or real(*a))
    spec = ML.ModelSpec("classify", "rf", num_trees=2)
    train = ML.prepare(_rows(spark), spec)
    pipeline, _ = ML.build_pipeline(spec)
    model = ML.fit_forest(pipeline, train, list(ML.NUMERIC), spark_rows=100)
    assert taken == [1] and model.transform(train).where("prediction IS NULL").count() == 0
