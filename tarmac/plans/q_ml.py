"""ML queries: features, the four estimators, the monthly model, model
save/load, and the evaluation/report tables built from model predictions.

Model outputs depend on the optimiser, so most of these have no SQL oracle
(rows-only check); the feature tables (indexer labels, one-hot sizes, assembled
width) do.  A fitted model is reused by the report queries of the same session
and data folder instead of being refitted for each table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from tarmac.operators import evaluate as EV
from tarmac.operators import wide as WI
from tarmac.plans import ml as ML
from tarmac.plans import oracle as O
from tarmac.plans.q_batch import FLIGHT_KEY, FLIGHT_KEY_SQL
from tarmac.plans.registry import register
from tarmac.session import Fixtures, remove_folder, work_dir
from tarmac.sinks import writers as W
from tarmac.sources import files as FS
from tarmac.sources.fixtures import flights, stored_flights_folder
from tarmac.functions.columns import route_label

PREDICTION_SAMPLE_ROWS = 10_000

_FITS = Fixtures(keep=4)
_TAGGED = Fixtures(keep=4)


def tagged_flights(spark: SparkSession, sf_dir: str):
    """The flights with both labels and their split, written and persisted once for the models of a session.

    Partitions that the memory does not hold are read again from the written table instead of being spilled.
    """
    folder = stored_flights_folder(spark, sf_dir)

    def make():
        path = work_dir(spark, "tagged")
        ML.tagged_rows(spark.read.parquet(folder), LR, FLIGHT_KEY).write.parquet(path)
        return spark.read.parquet(path).persist(StorageLevel.MEMORY_ONLY), path

    def clean_up(_, old):
        old[0].unpersist()
        remove_folder(spark, old[1])

    return _TAGGED.get(spark, sf_dir, folder, make, clean_up)[0]


def fitted(spark: SparkSession, sf_dir: str, spec: ML.ModelSpec) -> ML.FitResult:
    """Fit (or reuse, per session and state of the data) a pipeline on the flights."""
    # a fit that outlived the stored flights that it reads is made anew
    return _FITS.get(spark, sf_dir, (spec, stored_flights_folder(spark, sf_dir)),
                     lambda: ML.fit_tagged(tagged_flights(spark, sf_dir), spec), lambda _, old: old.scored.unpersist())


LR = ML.ModelSpec("classify", "lr")
RF = ML.ModelSpec("classify", "rf")
LINREG = ML.ModelSpec("regress", "linreg")
RFREG = ML.ModelSpec("regress", "rfreg")


# ---------------------------------------------------------------- features
def _distinct_rank_sql(col: str) -> str:
    return (f"SELECT '{col}' AS feature, {col} AS label, "
            f"CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {col}) - 1 AS INTEGER) AS index "
            f"FROM flights GROUP BY {col}")


ROUTE_SLOTS, ROUTE_OVERFLOW = 100, 16


@register(
    "fea2_bounded_index",
    O.oracle(
        f"""
        SELECT slot, CASE WHEN slot < {ROUTE_SLOTS} THEN MIN(route) ELSE '(other ' || (slot - {ROUTE_SLOTS}) || ')' END AS name,
               CAST(SUM(n) AS BIGINT) AS n
        FROM (SELECT route, n, CAST(CASE WHEN place <= {ROUTE_SLOTS} THEN place - 1
                     ELSE {ROUTE_SLOTS} + ('0x' || substr(md5(route), 1, 8))::BIGINT % {ROUTE_OVERFLOW} END AS INTEGER) AS slot
              FROM (SELECT route, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, route) AS place
                    FROM (SELECT origin || '→' || dest AS route FROM flights) GROUP BY route))
        GROUP BY slot"""),
)
def q_fea2_bounded(spark, sf):
    """Flights per slot of the route column: 100 routes of their own, 16 shared slots, whatever the number of routes."""
    routes = flights(spark, sf).select(route_label().alias("route"))
    index = WI.fit_index(routes, "route", ROUTE_SLOTS, ROUTE_OVERFLOW)
    slotted = WI.with_slot(routes, "route", index)
    names = F.array(*[F.lit(n) for n in index.names()])
    counts = slotted.groupBy(F.col("route_slot").cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("slot", F.get(names, F.col("slot")).alias("name"), "n")


@register("fea2_string_index", O.oracle("\nUNION ALL\n".join(_distinct_rank_sql(c) for c in ML.CATEGORICAL)))
def q_fea2(spark, sf):
    """Labels of the fitted indexers: most frequent first, ties alphabetical."""
    fl = flights(spark, sf)
    model = StringIndexer(inputCols=list(ML.CATEGORICAL), outputCols=[f"{c}_idx" for c in ML.CATEGORICAL],
                          stringOrderType="frequencyDesc", handleInvalid="keep").fit(fl)
    rows = [(c, label, i) for c, labels in zip(ML.CATEGORICAL, model.labelsArray)
            for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "feature string, label string, index int")


@register(
    "fea3_one_hot",
    O.oracle("\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST(COUNT(DISTINCT {c}) + 1 AS INTEGER) AS vector_size, "
        f"COUNT(*) AS n_rows, COUNT(*) AS n_hot FROM flights" for c in ML.CATEGORICAL)),
)
def q_fea3(spark, sf):
    """One-hot width per categorical and how many rows got a hot slot.

    The indexers keep unseen labels as one extra index, so each one-hot block is
    (known labels + 1) wide after dropping the encoder's own invalid slot.
    """
    fl = flights(spark, sf)
    cats = list(ML.CATEGORICAL)
    idx = [f"{c}_idx" for c in cats]
    oh = [f"{c}_oh" for c in cats]
    model = Pipeline(stages=[
        StringIndexer(inputCols=cats, outputCols=idx, handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=oh, handleInvalid="keep"),
    ]).fit(fl)
    enc = model.transform(fl)
    # the width is in the column's metadata; a row's hot slot is its index, so vectors stay sparse
    width = {o: enc.schema[o].metadata["ml_attr"]["num_attrs"] for o in oh}
    per = enc.agg(*[
        F.struct(F.lit(width[o]).alias("vector_size"), F.count(F.lit(1)).alias("n_rows"),
                 F.count_if((F.col(i) >= 0) & (F.col(i) < width[o])).alias("n_hot")).alias(c)
        for c, i, o in zip(cats, idx, oh)
    ])
    stacked = per.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}.vector_size").alias("vector_size"),
                 F.col(f"{c}.n_rows").alias("n_rows"), F.col(f"{c}.n_hot").alias("n_hot"))
        for c in cats])).alias("s"))
    return stacked.select("s.*")


@register(
    "fea4_vector_assemble",
    O.oracle("SELECT COUNT(*) AS n_rows, CAST(" + " + ".join(f"COUNT(DISTINCT {c}) + 1" for c in ML.CATEGORICAL)
             + f" + {len(ML.NUMERIC)} AS INTEGER) AS vector_size FROM flights"),
)
def q_fea4(spark, sf):
    """Assembled (linear-model) feature vector: rows and width."""
    fl = flights(spark, sf)
    stages, _ = ML.feature_stages(LR, ML.CATEGORICAL, ML.NUMERIC)
    assembled = Pipeline(stages=stages).fit(fl).transform(fl)
    width = assembled.schema["features"].metadata["ml_attr"]["num_attrs"]
    return assembled.agg(F.count_if(F.col("features").isNotNull()).alias("n_rows"), F.lit(width).alias("vector_size"))


# ------------------------------------------------------------------ models
# The split of a labelled flight, and the parts of the models' results that SQL can state.
TAGGED_SQL = f"""
    tagged AS (
        SELECT *, CAST(arr_delay > 15 AS INTEGER) AS delayed,
               CASE WHEN ('0x' || substr(md5({FLIGHT_KEY_SQL}), 1, 8))::BIGINT % 100 < 70
                    THEN 'train' ELSE 'test' END AS split
        FROM flights)"""


def _counts_sql(spec: ML.ModelSpec) -> str:
    suffix = "oh" if spec.algo in ML.LINEAR else "idx"
    features = ",".join([*(f"{c}_{suffix}" for c in ML.CATEGORICAL), *ML.NUMERIC])
    balance = ("CAST(count_if(delayed = 1) AS BIGINT)", "CAST(count_if(delayed = 0) AS BIGINT)")
    if spec.task == "regress":
        balance = ("NULL::BIGINT", "NULL::BIGINT")
    return f"""SELECT '{spec.task}' AS task, '{spec.algo}' AS algo, '{spec.label}' AS label_col,
                      CAST(count_if(split = 'train') AS BIGINT) AS n_train,
                      CAST(count_if(split = 'test') AS BIGINT) AS n_test, '{features}' AS features,
                      {balance[0]} AS positive, {balance[1]} AS negative FROM tagged"""


def _register_counts(name: str, *specs: ML.ModelSpec) -> None:
    @register(name, O.oracle("\nUNION ALL\n".join(map(_counts_sql, specs)), TAGGED_SQL))
    def counts(spark, sf):
        rows = [ML.run_counts(fitted(spark, sf, spec)) for spec in specs]
        return rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])


_register_counts("mod1_logistic_regression_counts", LR)
_register_counts("mod2_random_forest_classifier_counts", RF)
_register_counts("mod3_linear_regression_counts", LINREG)
_register_counts("mod4_random_forest_regressor_counts", RFREG)
_register_counts("met9_run_report_counts", LR, LINREG)


@register(
    "mod3_one_predictor",
    O.oracle("""SELECT round(regr_slope(arr_delay, dep_delay), 6) AS slope,
                       round(regr_intercept(arr_delay, dep_delay), 6) AS intercept,
                       round(regr_r2(arr_delay, dep_delay), 6) AS r2 FROM flights"""),
)
def q_mod3_one(spark, sf):
    """Linear regression on the departure delay alone: the closed form."""
    rows = VectorAssembler(inputCols=["dep_delay"], outputCol="features").transform(
        flights(spark, sf).select("arr_delay", "dep_delay").dropna())
    model = LinearRegression(labelCol="arr_delay", solver="normal").fit(rows)
    row = (round(float(model.coefficients[0]), 6), round(float(model.intercept), 6), round(float(model.summary.r2), 6))
    return spark.createDataFrame([row], "slope double, intercept double, r2 double")


@register(
    "mod1_one_predictor",
    O.oracle("""SELECT round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 3) AS coefficient,
                       round(ln(p0 / (1 - p0)), 3) AS intercept
                FROM (SELECT AVG(CASE WHEN dep_delay > 15 THEN delayed END) AS p1,
                             AVG(CASE WHEN dep_delay <= 15 THEN delayed END) AS p0 FROM tagged)""", TAGGED_SQL),
)
def q_mod1_one(spark, sf):
    """Logistic regression on one 0/1 predictor (late departure): the groups' log-odds."""
    fl = flights(spark, sf)
    rows = fl.select((F.col("arr_delay") > 15).cast("double").alias("delayed"),
                     (F.col("dep_delay") > 15).cast("double").alias("late"))
    model = LogisticRegression(labelCol="delayed", maxIter=200, tol=1e-10).fit(
        VectorAssembler(inputCols=["late"], outputCol="features").transform(rows))
    row = (round(float(model.coefficients[0]), 3), round(float(model.intercept), 3))
    return spark.createDataFrame([row], "coefficient double, intercept double")


@register(
    "mod2_single_tree_separable",
    O.oracle("SELECT dep_delay > 15 AS late, COUNT(*) AS n, CAST(COUNT(*) AS BIGINT) AS n_right FROM flights GROUP BY 1"),
)
def q_mod2_tree(spark, sf):
    """A single tree on a label that one split decides: every row is right."""
    rows = flights(spark, sf).select("dep_delay", (F.col("dep_delay") > 15).alias("late"))
    rows = rows.withColumn("y", F.col("late").cast("double"))
    data = VectorAssembler(inputCols=["dep_delay"], outputCol="features").transform(rows)
    model = RandomForestClassifier(labelCol="y", numTrees=1, maxDepth=2, maxBins=64, seed=1,
                                   bootstrap=False, featureSubsetStrategy="all").fit(data)
    return model.transform(data).groupBy("late").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("y")).alias("n_right"))


@register(
    "mod4_single_tree_separable",
    O.oracle("""SELECT dep_delay > 15 AS late, COUNT(*) AS n,
                       CAST(CASE WHEN dep_delay > 15 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM flights GROUP BY 1, 3"""),
)
def q_mod4_tree(spark, sf):
    """A single regression tree on a step of the departure delay: the step itself."""
    rows = flights(spark, sf).select("dep_delay", (F.col("dep_delay") > 15).alias("late"))
    rows = rows.withColumn("y", F.col("late").cast("double"))
    data = VectorAssembler(inputCols=["dep_delay"], outputCol="features").transform(rows)
    model = RandomForestRegressor(labelCol="y", numTrees=1, maxDepth=2, maxBins=64, seed=1,
                                  bootstrap=False, featureSubsetStrategy="all").fit(data)
    return model.transform(data).groupBy("late", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register(
    "mod5_monthly_table_counts",
    O.oracle("""SELECT month, airline, COUNT(*) AS total_flights, CAST(count_if(arr_delay > 15) AS BIGINT) AS total_delays,
                       AVG(arr_delay) AS avg_arr_delay FROM flights GROUP BY month, airline"""),
)
def q_mod5_table(spark, sf):
    """The monthly table that the monthly regression is fitted on."""
    return ML.monthly_table(flights(spark, sf))


@register(
    "mod6_scored_rows",
    O.oracle(f"""SELECT {', '.join(FLIGHT_KEY)}, delayed, COUNT(*) AS n, TRUE AS consistent
                 FROM tagged WHERE split = 'test' GROUP BY ALL""", TAGGED_SQL),
)
def q_mod6_rows(spark, sf):
    """The scored test rows; a prediction is consistent with its probability."""
    agrees = (F.col("p_delayed") > 0.5) == (F.col("prediction") == 1)
    pred = fitted(spark, sf, LR).predictions
    return pred.groupBy(*FLIGHT_KEY, "delayed").agg(F.count(F.lit(1)).alias("n"), F.every(agrees).alias("consistent"))


@register(
    "met4_confusion_totals_lr",
    O.oracle("SELECT CAST(delayed AS INTEGER) AS y, COUNT(*) AS n FROM tagged WHERE split = 'test' GROUP BY 1", TAGGED_SQL),
)
def q_met4_totals(spark, sf):
    """Row totals of the confusion matrix: the labels' counts in the test split."""
    matrix = EV.confusion_matrix(fitted(spark, sf, LR).scored, "delayed", "prediction")
    return matrix.groupBy("y").agg(F.sum("count").alias("n"))


@register(
    "met1_auc_counts",
    O.oracle("""SELECT CAST(count_if(delayed = 1) AS BIGINT) AS n_pos, CAST(count_if(delayed = 0) AS BIGINT) AS n_neg,
                       TRUE AS better_than_chance, TRUE AS evaluator_agrees FROM tagged WHERE split = 'test'""", TAGGED_SQL),
)
def q_met1_counts(spark, sf):
    """Class sizes behind the ROC-AUC, and whether the binned and the exact value agree."""
    m = ML.metrics(fitted(spark, sf, LR))
    row = (m["n_pos"], m["n_neg"], m["exact_auc"] > 0.5, abs(m["exact_auc"] - m["roc_auc"]) < 1e-2)
    return spark.createDataFrame([row], "n_pos long, n_neg long, better_than_chance boolean, evaluator_agrees boolean")


@register(
    "met7_coefficient_names",
    O.oracle("\nUNION ALL\n".join(
        f"SELECT '{c}_oh_' || {c} AS feature FROM flights GROUP BY {c} UNION ALL SELECT '{c}_oh___unknown'"
        for c in ML.CATEGORICAL) + "".join(f"\nUNION ALL SELECT '{c}'" for c in ML.NUMERIC)),
)
def q_met7_names(spark, sf):
    """Slots that the coefficients are keyed by."""
    return ML.coefficients(fitted(spark, sf, LR)).select("feature")


@register(
    "met6_importance_names",
    "SELECT * FROM (VALUES " + ", ".join(f"('{c}_idx')" for c in ML.CATEGORICAL) + ", "
    + ", ".join(f"('{c}')" for c in ML.NUMERIC) + ", ('total is 1')) AS v(feature)",
)
def q_met6_names(spark, sf):
    """Inputs that the importances are keyed by, and their total."""
    found = ML.feature_importances(fitted(spark, sf, RF))
    total = found.agg(F.round(F.sum("importance"), 6).alias("t")).where("t = 1").select(F.lit("total is 1").alias("feature"))
    return found.select("feature").unionByName(total)


@register(
    "met2_count_rfreg",
    O.oracle("SELECT COUNT(*) AS n, TRUE AS explains_variance FROM tagged WHERE split = 'test'", TAGGED_SQL),
)
def q_met2_count(spark, sf):
    """Rows behind the forest regressor's metrics, and whether it beats the mean."""
    m = EV.regression_metrics(fitted(spark, sf, RFREG).scored, "arr_delay", "prediction")
    return m.select("n", (F.col("r2") > 0).alias("explains_variance"))


@register(
    "met8_roc_ends_lr",
    "SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, TRUE AS monotone UNION ALL SELECT 1.0, 1.0, TRUE",
)
def q_met8_ends(spark, sf):
    """First and last point of the model's ROC curve, and that it never falls."""
    curve = EV.roc_curve(fitted(spark, sf, LR).scored, "delayed", "p_delayed")
    # thinned to the distinct rates of three digits: a thousand steps either way at most, one small window
    few = EV.roc_curve(fitted(spark, sf, LR).scored, "delayed", "p_delayed", digits=3)
    by_threshold = Window.orderBy(F.col("threshold").desc_nulls_first())
    rises = [(F.col(c) >= F.coalesce(F.lag(c).over(by_threshold), F.lit(0.0))).alias(c) for c in ("fpr", "tpr")]
    monotone = few.select(*rises).agg(F.every(F.col("fpr") & F.col("tpr")).alias("m")).scalar()
    ends = curve.where("threshold IS NULL OR (fpr = 1 AND tpr = 1)").select("fpr", "tpr").distinct()
    return ends.withColumn("monotone", monotone)


@register(
    "snk5_predictions_sample_rows",
    O.oracle(f"""SELECT {', '.join(FLIGHT_KEY)}, delayed FROM tagged WHERE split = 'test'
                 ORDER BY md5({FLIGHT_KEY_SQL}), {', '.join(c + ' NULLS FIRST' for c in FLIGHT_KEY)}
                 LIMIT {PREDICTION_SAMPLE_ROWS}""", TAGGED_SQL),
)
def q_snk5_rows(spark, sf):
    """Keys and labels of the sampled predictions, as read back from the CSV."""
    kinds = {f.name: f.dataType.simpleString() for f in flights(spark, sf).schema.fields}
    path = work_dir(spark, "predictions_sample")
    W.write_predictions_sample(fitted(spark, sf, LR).predictions, path, PREDICTION_SAMPLE_ROWS,
                               list(FLIGHT_KEY), "delayed")
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in FLIGHT_KEY), "delayed int, prediction double, probability string"])
    return FS.read_result_csv(spark, path, schema).select(*FLIGHT_KEY, "delayed")


@register("snk7_metrics_log_counts", O.oracle(_counts_sql(LR) + "\nUNION ALL\n" + _counts_sql(LINREG), TAGGED_SQL))
def q_snk7_counts(spark, sf):
    """Each run appends its row to the log table."""
    path = work_dir(spark, "counts_log")
    for spec in (LR, LINREG):
        W.append_metrics(ML.run_counts(fitted(spark, sf, spec)), path)
    return spark.read.parquet(path)


# How far a category's mean prediction may lie from its mean label: minutes, and a probability.
MEAN_TOLERANCE = {"linreg": 1e-6, "lr": 2e-3}


def _category_means_sql(label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS dimension, {c} AS category, COUNT(*) AS n, round(AVG({label}), 4) AS mean_label, TRUE AS mean_kept "
        f"FROM tagged WHERE split = 'train' GROUP BY {c}" for c in ML.CATEGORICAL)


def category_means(spark: SparkSession, sf_dir: str, spec: ML.ModelSpec):
    """Per category of the training rows: mean label, and whether the mean prediction equals it.

    An unregularised linear or logistic fit with an intercept and one-hot inputs has residuals that sum to zero in
    every category (its normal or score equations); a wrong coefficient breaks that.  One scan of the training rows.
    """
    fit = fitted(spark, sf_dir, spec)
    scored = fit.model.transform(fit.train)
    value = vector_to_array("probability")[1] if spec.task == "classify" else F.col("prediction")
    rows = scored.select(*ML.CATEGORICAL, F.col(spec.label).cast("double").alias("label"), value.alias("value"))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("category")) for c in ML.CATEGORICAL]))
    means = rows.select(cells.alias("_c"), "label", "value").groupBy("_c.dimension", "_c.category").agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("label"), F.avg("value").alias("value"))
    kept = F.abs(F.col("label") - F.col("value")) <= MEAN_TOLERANCE[spec.algo]
    return means.select("dimension", "category", "n", F.round("label", 4).alias("mean_label"), kept.alias("mean_kept"))


@register("mod3_category_means", O.oracle(_category_means_sql("arr_delay"), TAGGED_SQL))
def q_mod3_means(spark, sf):
    """The linear regression's normal equations hold for every airline, airport and weekday (tolerance 1e-6 minutes)."""
    return category_means(spark, sf, LINREG)


@register("mod1_category_means", O.oracle(_category_means_sql("delayed"), TAGGED_SQL))
def q_mod1_means(spark, sf):
    """The logistic regression's score equations hold for every category (tolerance 0.002)."""
    return category_means(spark, sf, LR)


@register("mod1_logistic_regression")
def q_mod1(spark, sf):
    return ML.run_report(fitted(spark, sf, LR))


@register("mod2_random_forest_classifier")
def q_mod2(spark, sf):
    return ML.run_report(fitted(spark, sf, RF))


@register("mod3_linear_regression")
def q_mod3(spark, sf):
    return ML.run_report(fitted(spark, sf, LINREG))


@register("mod4_random_forest_regressor")
def q_mod4(spark, sf):
    return ML.run_report(fitted(spark, sf, RFREG))


@register("mod5_monthly_linear_regression")
def q_mod5(spark, sf):
    return ML.monthly_regression(flights(spark, sf))


@register("mod6_pipeline_fit_score")
def q_mod6(spark, sf):
    """Every test-split flight with its label, predicted class and probability."""
    pred = fitted(spark, sf, LR).predictions
    return pred.select(*FLIGHT_KEY, "delayed", "prediction", "p_delayed")


def save_and_load(spark: SparkSession, result: ML.FitResult) -> PipelineModel:
    path = work_dir(spark, f"model_{result.spec.task}_{result.spec.algo}")
    W.save_model(result.model, path)
    return PipelineModel.load(path)


@register(
    "mod7_model_load",
    O.oracle("""SELECT COUNT(*) AS n_scored, CAST(0 AS BIGINT) AS n_prediction_mismatch,
                       CAST(0 AS DOUBLE) AS max_probability_diff FROM tagged WHERE split = 'test'""", TAGGED_SQL),
)
def q_mod7(spark, sf):
    """Saved-then-loaded pipeline scores the test split exactly like the fitted one."""
    result = fitted(spark, sf, LR)
    loaded = save_and_load(spark, result)
    first = result.predictions.select(*result.test.columns, F.col("prediction").alias("p_mem"),
                                      F.col("p_delayed").alias("q_mem"))
    again = loaded.transform(first).withColumn("q_load", vector_to_array("probability")[1])
    return again.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("p_mem") != F.col("prediction")).alias("n_prediction_mismatch"),
        F.max(F.abs(F.col("q_mem") - F.col("q_load"))).alias("max_probability_diff"),
    )


@register(
    "snk6_model_save",
    """SELECT * FROM (VALUES (0, 'StringIndexerModel'), (1, 'OneHotEncoderModel'), (2, 'VectorAssembler'),
                             (3, 'LogisticRegressionModel')) AS v(stage, kind)""",
)
def q_snk6(spark, sf):
    """Stages of the saved pipeline, read back from its folder."""
    loaded = save_and_load(spark, fitted(spark, sf, LR))
    rows = [(i, type(s).__name__) for i, s in enumerate(loaded.stages)]
    return spark.createDataFrame(rows, "stage int, kind string")


# -------------------------------------------------------------- evaluation
@register("met1_roc_auc")
def q_met1(spark, sf):
    """Spark's binned evaluator next to the exact rank-formula AUC (test split)."""
    m = ML.metrics(fitted(spark, sf, LR))
    row = (m["n_pos"], m["n_neg"], m["roc_auc"], m["exact_auc"])
    return spark.createDataFrame([row], "n_pos long, n_neg long, evaluator_auc double, exact_auc double")


@register("met4_confusion_matrix_lr")
def q_met4_lr(spark, sf):
    return EV.confusion_matrix(fitted(spark, sf, LR).scored, "delayed", "prediction")


@register("met4_confusion_summary_lr")
def q_met4_sum(spark, sf):
    return EV.confusion_summary(fitted(spark, sf, LR).scored, "delayed", "prediction")


@register("met2_rmse_r2_rfreg")
def q_met2_rfreg(spark, sf):
    return EV.regression_metrics(fitted(spark, sf, RFREG).scored, "arr_delay", "prediction")


@register("met6_feature_importances")
def q_met6(spark, sf):
    return ML.feature_importances(fitted(spark, sf, RF))


@register("met6_feature_importances_rfreg")
def q_met6_reg(spark, sf):
    return ML.feature_importances(fitted(spark, sf, RFREG))


@register("met7_coefficients")
def q_met7(spark, sf):
    return ML.coefficients(fitted(spark, sf, LR))


@register("met7_coefficients_linreg")
def q_met7_reg(spark, sf):
    return ML.coefficients(fitted(spark, sf, LINREG))


@register("met8_roc_curve_lr")
def q_met8_lr(spark, sf):
    return EV.roc_curve(fitted(spark, sf, LR).scored, "delayed", "p_delayed")


@register("met9_run_report")
def q_met9(spark, sf):
    """One report row per linear model (classification and regression)."""
    return ML.run_report(fitted(spark, sf, LR)).unionByName(ML.run_report(fitted(spark, sf, LINREG)))


@register("snk5_predictions_sample")
def q_snk5(spark, sf):
    """10,000 test predictions with the smallest key hashes, written as CSV and read back."""
    path = work_dir(spark, "predictions_sample")
    W.write_predictions_sample(fitted(spark, sf, LR).predictions, path, PREDICTION_SAMPLE_ROWS,
                               list(FLIGHT_KEY), "delayed")
    return FS.read_result_csv(spark, path)


@register("snk7_metrics_log")
def q_snk7(spark, sf):
    """Each run appends its report row to the log table."""
    path = work_dir(spark, "metrics_log")
    for spec in (LR, LINREG):
        W.append_metrics(ML.run_report(fitted(spark, sf, spec)), path)
    return spark.read.parquet(path)
