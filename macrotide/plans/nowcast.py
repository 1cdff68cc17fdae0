"""Walk-forward evaluation, pooled model, feature importance and future-month nowcasts."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.functions.numeric import level_from_change, residual
from macrotide.operators.keyed import append_if_absent, replace_by_key
from macrotide.operators.quality import non_finite
from macrotide.operators.windows import add_expanding, add_previous, last_known, series_window
from macrotide.plans.features import KEYS, LEVEL, TARGET, align_features, inference_matrix
from macrotide.schemas import WALK_FORWARD
from macrotide.session import cut_lineage, scratch_path

# First training end, ensemble seeds and least number of training rows.
TRAIN_STOP = date(2023, 7, 1)
SEEDS = (42, 123, 456)
MIN_TRAIN_ROWS = 24


def _errors(df: DataFrame, *labels: str) -> DataFrame:
    """Complete ``previous level, predicted change`` rows to the walk-forward row shape."""
    levelled = df.withColumn("y_pred_level", level_from_change("previous_level", "y_pred_mom"))
    out = levelled.select(
        "month", "geo", *labels, F.col(LEVEL).alias("y_true_level"), "y_pred_level",
        F.col(TARGET).alias("y_true_mom"), "y_pred_mom",
        residual(LEVEL, "y_pred_level").alias("residual"))
    return out.withColumn("abs_error", F.abs("residual"))


def training_problems(matrix: DataFrame, features: list[str], cutoff: date) -> DataFrame:
    """Reasons not to train, as ``rule, subject, failures``: short histories and non-finite columns."""
    early = F.count(F.when(F.col("month") <= F.lit(cutoff), 1))
    short = matrix.groupBy("geo").agg(early.alias("failures")).filter(F.col("failures") < MIN_TRAIN_ROWS).select(
        F.lit("minimum_rows").alias("rule"), F.col("geo").alias("subject"), "failures")
    bad = non_finite(matrix.select([F.col(c).cast("double").alias(c) for c in [*features, TARGET, LEVEL]]), [*features, TARGET, LEVEL])
    return short.unionByName(bad.filter(F.col("failures") > 0).select("rule", F.col("column_name").alias("subject"), "failures"))


BASELINES = ("expanding_mean", "last_value", "expanding_linear")


def baseline_walk_forward(matrix: DataFrame, start_after: date, models: tuple[str, ...] = BASELINES) -> DataFrame:
    """Walk-forward rows of closed-form models, from expanding windows only.

    ``expanding_mean`` predicts the mean of all earlier changes, ``last_value`` the newest one and
    ``expanding_linear`` regresses a change on the one before it. Every prediction uses earlier rows.
    """
    lagged = add_previous(add_previous(matrix, LEVEL, ["geo"], "previous_level"), TARGET, ["geo"], "previous_mom")
    fitted = add_expanding(
        lagged, ["geo"], "month",
        expanding_mean=F.avg(TARGET),
        _slope=F.regr_slope(TARGET, "previous_mom"), _intercept=F.regr_intercept(TARGET, "previous_mom"))
    predicted = fitted.select(
        *KEYS, TARGET, LEVEL, "previous_level", "expanding_mean", F.col("previous_mom").alias("last_value"),
        (F.col("_intercept") + F.col("_slope") * F.col("previous_mom")).alias("expanding_linear"))
    tested = predicted.filter((F.col("month") > F.lit(start_after)) & F.col("previous_level").isNotNull())
    tall = tested.unpivot(
        [*KEYS, TARGET, LEVEL, "previous_level"], list(models),
        "model", "y_pred_mom").filter(F.col("y_pred_mom").isNotNull())
    return _errors(tall, "model")


def gbt(features: list[str], trees: int = 300, seed: int = 42) -> Pipeline:
    """Boosted-tree pipeline with fixed depth, rate and subsampling (MLlib has no L1/L2 penalties).

    A missing feature is kept as NaN, which every split sends to its right side, so a series without
    some driver is still scored.
    """
    learner = GBTRegressor(
        featuresCol="features", labelCol=TARGET, predictionCol="y_pred_mom", maxIter=trees, maxDepth=3,
        stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), learner])


def fit_pooled(matrix: DataFrame, features: list[str], trees: int = 300, seed: int = 42) -> PipelineModel:
    """One distributed model over the rows of all geos."""
    return gbt(features, trees, seed).fit(matrix)


def walk_forward_pooled(matrix: DataFrame, features: list[str], start_after: date = TRAIN_STOP,
                        seeds: tuple[int, ...] = SEEDS, trees: int = 300, parallel: int = 4) -> DataFrame:
    """Walk-forward with one pooled MLlib model per test month and seed.

    The loop runs over test months, which the calendar bounds; each fit is a distributed job over all geos, and
    ``parallel`` of them are submitted at a time. The matrix is written once, so no fit recomputes it, and
    all predictions go to one table in the shared folder. Runs its jobs when it is called.
    """
    spark = matrix.sparkSession
    lagged = cut_lineage(add_previous(matrix, LEVEL, ["geo"], "previous_level"), "matrix")
    months = [r[0] for r in lagged.filter(F.col("month") > F.lit(start_after))
              .select("month").distinct().orderBy("month").collect()]
    path = scratch_path(spark, "folds")

    def fold(month: date, seed: int) -> None:
        history = lagged.filter(F.col("month") < F.lit(month))
        test = lagged.filter((F.col("month") == F.lit(month)) & F.col("previous_level").isNotNull())
        fit_pooled(history, features, trees, seed).transform(test).select(
            *KEYS, TARGET, LEVEL, "previous_level", "y_pred_mom").write.parquet(f"{path}/month={month}/seed={seed}")

    if not months:
        return spark.createDataFrame([], WALK_FORWARD)
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(lambda job: fold(*job), [(m, s) for m in months for s in seeds]))
    files = [f"{path}/month={m}/seed={s}" for m in months for s in seeds]
    schema = lagged.select(*KEYS, TARGET, LEVEL, "previous_level", F.lit(0.0).alias("y_pred_mom")).schema
    folds = spark.read.schema(schema).parquet(*files)
    mean = folds.groupBy(*KEYS).agg(F.avg("y_pred_mom").alias("y_pred_mom"), *[F.max(c).alias(c) for c in (TARGET, LEVEL, "previous_level")])
    return _errors(mean)


def errors_beside_baseline(rows: DataFrame, matrix: DataFrame, start_after: date = TRAIN_STOP, baseline: str = "expanding_mean") -> DataFrame:
    """Mean absolute level error of walk-forward rows and of a closed-form model, per geo: ``geo, n_months, mae, baseline_mae``."""
    naive = baseline_walk_forward(matrix, start_after, (baseline,)).groupBy("geo").agg(F.avg("abs_error").alias("baseline_mae"))
    own = rows.groupBy("geo").agg(F.count("*").alias("n_months"), F.avg("abs_error").alias("mae"))
    return own.join(naive, "geo").select("geo", "n_months", "mae", "baseline_mae")


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """``feature, importance`` rows of a fitted pipeline (one per feature, so driver-sized by design)."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [F.struct(F.lit(n).alias("feature"), F.lit(float(w)).alias("importance")) for n, w in zip(names, weights)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def future_rows(nowcast_input: DataFrame, target: date, fill_lags: bool = True) -> DataFrame:
    """Input plus a row per geo for the target month where there is none.

    ``fill_lags`` takes the new row's lags from the levels before it; otherwise they stay NULL and the
    later forward fill repeats the previous row's lags.
    """
    new = nowcast_input.select("geo").distinct().withColumn("month", F.lit(target))
    out = append_if_absent(nowcast_input, new, KEYS)
    if not fill_lags:
        return out
    w = series_window(["geo"])
    lags = {f"lag_{n}m": n for n in (1, 3, 6, 12)}
    return out.select([
        F.when(F.col("month") == F.lit(target), F.coalesce(F.col(c), F.lag(LEVEL, lags[c]).over(w)))
        .otherwise(F.col(c)).alias(c) if c in lags else F.col(c) for c in out.columns])


def nowcast_month(model: PipelineModel, nowcast_input: DataFrame, target: date, fill_lags: bool = True) -> DataFrame:
    """Nowcast of the target month for every geo with a known earlier level.

    ``geo, month, mom_pred, level_pred, last_known_month, last_known_level``.
    """
    matrix = inference_matrix(future_rows(nowcast_input, target, fill_lags))
    known = last_known(nowcast_input, LEVEL, ["geo"], target)
    expected = model.stages[0].getInputCols()
    rows = align_features(matrix.filter(F.col("month") == F.lit(target)), expected)
    scored = model.transform(rows).select("geo", "month", F.col("y_pred_mom").alias("mom_pred"))
    return scored.join(known, "geo").select(
        "geo", "month", "mom_pred", level_from_change("last_known_level", "mom_pred").alias("level_pred"),
        "last_known_month", "last_known_level")


def save_nowcast(output: DataFrame, nowcasts: DataFrame, created_at, model_version: str = "nowcast_future") -> DataFrame:
    """Nowcast output table with the new predictions in place of any earlier row of their month and geo."""
    rows = nowcasts.select(
        "month", "geo", F.lit(model_version).alias("model_version"), F.col("level_pred").alias("y_nowcast"),
        F.lit(None).cast(T.DoubleType()).alias("y_actual"), F.lit(None).cast(T.DoubleType()).alias("residual"),
        created_at.alias("created_at_utc"))
    return replace_by_key(output, rows, ["month", "geo"])
