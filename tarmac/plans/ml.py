"""Spark ML pipelines for delay classification and regression.

Task x algorithm:  classify -> lr (logistic regression) | rf (random forest)
                   regress  -> linreg (linear regression) | rfreg (random forest)

Categoricals are indexed (unseen values kept as an extra index); linear models
one-hot encode them, tree models use the indices.  The train/test split is a hash
of the row's key columns (repeatable on any cluster).  The source is read once: the
narrow table of labelled rows is tagged with its split and persisted (``fit_tagged`` fits
several models on one such table), and the scored test rows are persisted in their narrow form, from which all metrics are aggregates.
The whole pipeline — indexers, encoder, assembler, estimator — is what gets saved.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.columns import delayed_label
from tarmac.operators import evaluate as EV
from tarmac.operators import forest as FO
from tarmac.operators.sampling import train_test_split, with_split

CATEGORICAL = ("airline", "origin", "dest", "day_of_week")
NUMERIC = ("dep_delay", "distance", "month", "year")
ALGOS = {"classify": ("lr", "rf"), "regress": ("linreg", "rfreg")}
LINEAR = ("lr", "linreg")
FOREST_PARTITION_ROWS = 500_000
# the largest training table that Spark's own forest is given: about 2.5 GB with its counts per tree
SPARK_FOREST_ROWS = 5_000_000


@dataclass(frozen=True)
class ModelSpec:
    task: str = "classify"
    algo: str = "lr"
    label_threshold: float = 15.0
    max_iter: int = 50
    num_trees: int | None = None  # default: 80 (rf) / 120 (rfreg)
    max_bins: int = 4096
    seed: int = 42
    train_pct: int = 70

    def __post_init__(self):
        if self.task not in ALGOS:
            raise ValueError(f"task must be one of {list(ALGOS)}")
        if self.algo not in ALGOS[self.task]:
            raise ValueError(f"algo {self.algo!r} does not fit task {self.task!r}; use {ALGOS[self.task]}")

    @property
    def label(self) -> str:
        return "delayed" if self.task == "classify" else "arr_delay"

    @property
    def trees(self) -> int:
        return self.num_trees or (80 if self.algo == "rf" else 120)


@dataclass
class FitResult:
    spec: ModelSpec
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    feature_cols: list[str]
    tagged: DataFrame  # persisted: labelled rows with their split
    scored: DataFrame  # persisted: test labels, predictions and scores

    @property
    def estimator(self):
        return self.model.stages[-1]

    def release(self) -> None:
        self.scored.unpersist()
        self.tagged.unpersist()


def prepare(df: DataFrame, spec: ModelSpec, categorical=CATEGORICAL, numeric=NUMERIC) -> DataFrame:
    """Label column plus the rows that carry a label and every feature.

    Rows lacking a label or a numeric feature cannot be scored; they are left out
    explicitly here (VectorAssembler would otherwise fail on the first one).
    """
    out = df
    if spec.task == "classify":
        out = out.withColumn("delayed", delayed_label("arr_delay", spec.label_threshold))
    needed = [spec.label] + [c for c in numeric if c in out.columns]
    return out.dropna(subset=needed)


def feature_stages(spec: ModelSpec, categorical: Sequence[str], numeric: Sequence[str]):
    # one multi-column indexer: all label counts come from a single pass
    stages = [
        StringIndexer(inputCols=list(categorical), outputCols=[f"{c}_idx" for c in categorical],
                      handleInvalid="keep", stringOrderType="frequencyDesc")
    ]
    if spec.algo in LINEAR:
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical],
                                    outputCols=[f"{c}_oh" for c in categorical], handleInvalid="keep"))
        features = [f"{c}_oh" for c in categorical] + list(numeric)
    else:
        features = [f"{c}_idx" for c in categorical] + list(numeric)
    stages.append(VectorAssembler(inputCols=features, outputCol="features"))
    return stages, features


def estimator(spec: ModelSpec):
    label, feats = spec.label, "features"
    if spec.algo == "lr":
        return LogisticRegression(labelCol=label, featuresCol=feats, maxIter=spec.max_iter)
    if spec.algo == "rf":
        return RandomForestClassifier(labelCol=label, featuresCol=feats, numTrees=spec.trees,
                                      maxBins=spec.max_bins, seed=spec.seed)
    if spec.algo == "linreg":
        return LinearRegression(labelCol=label, featuresCol=feats, maxIter=spec.max_iter)
    return RandomForestRegressor(labelCol=label, featuresCol=feats, numTrees=spec.trees,
                                 maxBins=spec.max_bins, seed=spec.seed)


def build_pipeline(spec: ModelSpec, categorical=CATEGORICAL, numeric=NUMERIC) -> tuple[Pipeline, list[str]]:
    stages, features = feature_stages(spec, categorical, numeric)
    return Pipeline(stages=stages + [estimator(spec)]), features


def tagged_rows(df: DataFrame, spec: ModelSpec, key_cols: Sequence[str], categorical=CATEGORICAL, numeric=NUMERIC) -> DataFrame:
    """The labelled rows with their split: only the key, the model's columns and the split."""
    source = [c for c in dict.fromkeys([*key_cols, *categorical, *numeric, "arr_delay"]) if c in df.columns]
    return with_split(prepare(df.select(*source), spec, categorical, numeric), key_cols, spec.train_pct)


def fit_and_score(
    df: DataFrame,
    spec: ModelSpec,
    key_cols: Sequence[str],
    categorical=CATEGORICAL,
    numeric=NUMERIC,
) -> FitResult:
    """Split by key hash, fit on train, score test.

    The tagged rows are persisted: the indexer pass, the estimator's iterations and the
    scoring re-read that table, not the source.
    """
    categorical = [c for c in categorical if c in df.columns]
    numeric = [c for c in numeric if c in df.columns]
    tagged = tagged_rows(df, spec, key_cols, categorical, numeric).persist(StorageLevel.MEMORY_AND_DISK)
    return fit_tagged(tagged, spec, categorical, numeric)


def fit_tagged(tagged: DataFrame, spec: ModelSpec, categorical=CATEGORICAL, numeric=NUMERIC) -> FitResult:
    """``fit_and_score`` on rows that are tagged already.

    Rows tagged for classification serve regression too (both labels are there), so that several
    models can share one persisted table.
    """
    tagged = tagged if spec.task == "classify" or "delayed" not in tagged.columns else tagged.dropna(subset=[spec.label])
    features = [*categorical, *numeric, spec.label]
    train = tagged.where("split = 'train'").select(*dict.fromkeys(features))
    test = tagged.where("split = 'test'").drop("split")
    pipeline, feature_cols = build_pipeline(spec, categorical, numeric)
    model = pipeline.fit(train) if spec.algo in LINEAR else fit_forest(pipeline, train, numeric)
    pred = model.transform(test)
    if spec.task == "classify":
        pred = pred.withColumn("p_delayed", vector_to_array("probability")[1])
    narrow = [spec.label, "prediction"] + [c for c in ("rawPrediction", "p_delayed") if c in pred.columns]
    scored = pred.select(*narrow).persist(StorageLevel.MEMORY_AND_DISK)
    return FitResult(spec, model, train, test, pred, feature_cols, tagged, scored)


def forest_rows(train: DataFrame, numeric: Sequence[str], per_partition: int = FOREST_PARTITION_ROWS) -> DataFrame:
    """The training rows laid out for a forest: bounded partitions, near rows next to each other.

    Spark's forest keeps a count per tree beside every row and adds each row to one node of every tree, so a partition
    of many rows fills the memory, and rows in no order touch all nodes' statistics (tens of MB a task) at random.  Ranges
    of the inputs bound both: neighbours fall into the same nodes and bins.  A table of one such partition stays as it lies.
    """
    n = train.count()
    if n <= per_partition:
        return train
    order = [*numeric, *(c for c in train.columns if c not in numeric)]
    parts = max(-(-n // per_partition), train.sparkSession.sparkContext.defaultParallelism)
    return train.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def fit_forest(pipeline: Pipeline, train: DataFrame, numeric: Sequence[str], spark_rows: int = SPARK_FOREST_ROWS) -> PipelineModel:
    """``pipeline.fit(train)``: the forest, its last stage, is Spark's own up to ``spark_rows`` rows, laid out by ``forest_rows``.

    Above that, Spark's forest would keep some 500 bytes a row; ``operators.forest`` grows the same one in blocks.
    """
    *features, forest = pipeline.getStages()
    prepared = Pipeline(stages=features).fit(train)
    if train.count() > spark_rows:
        grown = FO.fit(forest, prepared.transform(train), features[-1].getInputCols())
    else:
        grown = forest.fit(prepared.transform(forest_rows(train, numeric)))
    return PipelineModel([*prepared.stages, grown])


# ------------------------------------------------------------------ reports
def feature_names(pred: DataFrame, col: str = "features") -> list[str]:
    """Names of the assembled vector's slots, from the column's ML metadata.

    One-hot slots are named ``<input>_oh_<category>``; this is what the
    coefficient table is keyed by (its length is the vector size, not the number
    of input columns).
    """
    attrs = pred.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    slots: dict[int, str] = {}
    for group in attrs.values():
        for a in group:
            slots[a["idx"]] = a.get("name", f"f{a['idx']}")
    size = pred.schema[col].metadata.get("ml_attr", {}).get("num_attrs", len(slots))
    return [slots.get(i, f"f{i}") for i in range(size)]


def _named_values(spark, names: list[str], values: list[float], value_col: str) -> DataFrame:
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField(value_col, T.DoubleType())])
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, schema).orderBy(F.col(value_col).desc(), "feature")


def feature_importances(result: FitResult) -> DataFrame:
    """Tree models: importance per assembled feature, largest first."""
    est = result.estimator
    if not hasattr(est, "featureImportances"):
        raise ValueError(f"{result.spec.algo} has no feature importances")
    names = feature_names(result.predictions)
    return _named_values(result.predictions.sparkSession, names,
                         est.featureImportances.toArray().tolist(), "importance")


def coefficients(result: FitResult) -> DataFrame:
    """Linear models: coefficient per assembled slot (one-hot expanded), largest first."""
    est = result.estimator
    if not hasattr(est, "coefficients"):
        raise ValueError(f"{result.spec.algo} has no coefficients")
    names = feature_names(result.predictions)
    return _named_values(result.predictions.sparkSession, names,
                         est.coefficients.toArray().tolist(), "coefficient")


def metrics(result: FitResult) -> dict:
    spec, pred = result.spec, result.scored
    if spec.task == "classify":
        auc = BinaryClassificationEvaluator(labelCol=spec.label, metricName="areaUnderROC").evaluate(pred)
        exact = EV.exact_auc(pred, spec.label, "p_delayed").first()
        return {"roc_auc": float(auc), "exact_auc": exact["auc"], "n_pos": exact["n_pos"], "n_neg": exact["n_neg"]}
    reg = EV.regression_metrics(pred, spec.label, "prediction").first()
    return {"rmse": reg["rmse"], "r2": reg["r2"],
            "evaluator_rmse": float(RegressionEvaluator(labelCol=spec.label, metricName="rmse").evaluate(pred))}


REPORT_SCHEMA = T.StructType([
    T.StructField("task", T.StringType()),
    T.StructField("algo", T.StringType()),
    T.StructField("label_col", T.StringType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("features", T.StringType()),
    T.StructField("positive", T.LongType()),
    T.StructField("negative", T.LongType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("exact_auc", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
])


def run_report(result: FitResult) -> DataFrame:
    """One row describing the run: sizes, features, class balance, metrics."""
    m = metrics(result)
    scores = [F.lit(m.get(k)).cast("double").alias(k) for k in ("roc_auc", "exact_auc", "rmse", "r2")]
    return run_counts(result).select("*", *scores).select(*[f.name for f in REPORT_SCHEMA.fields])


def run_counts(result: FitResult) -> DataFrame:
    """The part of the report that no optimiser decides: split sizes, features, class balance."""
    spec, y = result.spec, F.col(result.spec.label)
    balance = [F.count_if(y == v) if spec.task == "classify" else F.lit(None).cast("long") for v in (1, 0)]
    return result.tagged.agg(
        F.lit(spec.task).alias("task"), F.lit(spec.algo).alias("algo"), F.lit(spec.label).alias("label_col"),
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"),
        F.lit(",".join(result.feature_cols)).alias("features"),
        balance[0].alias("positive"), balance[1].alias("negative"),
    )


# ------------------------------------------------- monthly aggregate model
def monthly_table(flights: DataFrame, threshold: float = 15.0) -> DataFrame:
    """Per (month of year, airline): flights, delayed flights, mean delay."""
    return flights.groupBy("month", "airline").agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(F.col("arr_delay") > threshold).alias("total_delays"),
        F.avg("arr_delay").alias("avg_arr_delay"),
    )


def monthly_regression(flights: DataFrame, train_pct: int = 80, max_iter: int = 100) -> DataFrame:
    """Linear regression of the monthly mean delay on month, volume, delays, airline.

    The monthly table is aggregated from the flights first (small: months x
    airlines); reports training-summary and test RMSE / R².
    """
    # months x airlines: a few hundred rows, aggregated once
    table = monthly_table(flights).na.drop().persist(StorageLevel.MEMORY_AND_DISK)
    # the airline index is fitted on the whole (small) monthly table, so every
    # airline of the test split is known
    indexed = StringIndexer(inputCol="airline", outputCol="airline_index").fit(table).transform(table)
    assembled = VectorAssembler(
        inputCols=["month", "total_flights", "total_delays", "airline_index"], outputCol="features"
    ).transform(indexed)
    train, test = train_test_split(assembled, ["month", "airline"], train_pct)
    model = LinearRegression(featuresCol="features", labelCol="avg_arr_delay", maxIter=max_iter).fit(train)
    summary = model.summary
    test_m = EV.regression_metrics(model.transform(test), "avg_arr_delay", "prediction").first()
    row = (train.count(), int(test_m["n"]), float(summary.rootMeanSquaredError), float(summary.r2),
           test_m["rmse"], test_m["r2"])
    table.unpersist()
    schema = "n_train long, n_test long, train_rmse double, train_r2 double, test_rmse double, test_r2 double"
    return flights.sparkSession.createDataFrame([row], schema)
