"""ML and streaming behaviour on the small tables."""

import pytest

from tarmac.plans import ml as ML
from tarmac.plans.catalog import QUERIES

from conftest import SF_SMALL


def test_invalid_task_algo_pairs_are_rejected():
    with pytest.raises(ValueError):
        ML.ModelSpec("classify", "linreg")
    with pytest.raises(ValueError):
        ML.ModelSpec("regress", "rf")


def test_logistic_model_report_and_reload(spark):
    rep = QUERIES["mod1_logistic_regression"](spark, SF_SMALL).first()
    assert rep["n_train"] > rep["n_test"] > 0
    assert rep["roc_auc"] > 0.9 and abs(rep["roc_auc"] - rep["exact_auc"]) < 1e-3
    same = QUERIES["mod7_model_load"](spark, SF_SMALL).first()
    assert same["n_prediction_mismatch"] == 0 and same["max_probability_diff"] == 0.0


def test_coefficients_are_named_per_vector_slot(spark):
    coef = QUERIES["met7_coefficients"](spark, SF_SMALL)
    width = QUERIES["fea4_vector_assemble"](spark, SF_SMALL).first()["vector_size"]
    assert coef.count() == width
    assert coef.where("feature = 'dep_delay'").count() == 1


def test_stream_score_covers_every_replayed_row(spark):
    from tarmac.sources.fixtures import flights

    scored = QUERIES["str2_stream_score"](spark, SF_SMALL)
    assert scored.count() == flights(spark, SF_SMALL).count()
    assert scored.where("pred_delayed NOT IN (0.0, 1.0)").count() == 0


def _delays(spark, n):
    rows = spark.range(n).selectExpr(
        "id", "concat('A', id % 5) airline", "concat('O', id % 7) origin", "concat('D', id % 3) dest", "concat('W', id % 2) day_of_week",
        "double((id * 7919) % 61) dep_delay", "double((id * 104729) % 997) distance", "int(id % 12) month", "int(id % 3) year")
    return rows.selectExpr("*", "dep_delay + id % 4 arr_delay").drop("id").repartition(3)


def test_forest_rows_lie_in_bounded_ordered_partitions(spark):
    """Every row stays, no partition is far above the bound, and neighbours have near inputs."""
    train = _delays(spark, 6000)
    laid = ML.forest_rows(train, list(ML.NUMERIC), per_partition=300)
    parts = laid.select("dep_delay", "distance").rdd.glom().map(lambda rows: [tuple(r) for r in rows]).collect()
    assert max(map(len, parts)) <= 600 and sum(map(len, parts)) == 6000
    assert all(p == sorted(p) for p in parts)
    assert train.exceptAll(laid).isEmpty() and laid.exceptAll(train).isEmpty()
    assert ML.forest_rows(train, list(ML.NUMERIC), per_partition=6000) is train


@pytest.mark.parametrize("task, algo", [("classify", "rf"), ("regress", "rfreg")])
def test_forest_of_a_small_table_is_the_pipelines_own(spark, task, algo):
    spec = ML.ModelSpec(task, algo, num_trees=3)
    train = ML.prepare(_delays(spark, 2000), spec).cache()
    pipeline, _ = ML.build_pipeline(spec)
    own, plain = ML.fit_forest(pipeline, train, list(ML.NUMERIC)), pipeline.fit(train)
    trees = [[t.toDebugString.split("\n", 1)[1] for t in m.stages[-1].trees] for m in (own, plain)]
    assert trees[0] == trees[1] and len(own.stages) == len(plain.stages)
    train.unpersist()
