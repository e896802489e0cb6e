"""Cross-validation over given folds, for closed-form ridge and for any Spark ML estimator."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.constants import FOLD, KEY, RIDGE_ALPHA, TARGETS
from sward.functions.scalars import clip_lower, sql_name, sql_text
from sward.operators.bounded import held
from sward.operators.features import training_rows, validation_rows
from sward.operators.folds import checked_folds, covered_folds, found_folds
from sward.plans import forests
from sward.plans.ridge import single_feature_fits

EstimatorFactory = Callable[[], Estimator]
JobFactory = Callable[[int, str], Estimator]


def _fold_fits(
    df: DataFrame, features: Mapping[str, str], models: Mapping[str, float], targets: Sequence[str], folds: Sequence[int] | None
) -> tuple[list[tuple[str, float, str, str, str]], DataFrame]:
    """The plan, ``(model, alpha, feature set, column, target)``, and a row per fold with slopes and intercepts in its order."""
    fits = single_feature_fits(df, list(features.values()), list(models.values()), targets, folds)
    plan = [(m, a, n, c, t) for m, a in models.items() for n, c in features.items() for t in targets]

    def fitted(what: str):
        """All of one kind of number as an array in the order of the plan."""
        cells = [
            f"max({what}) FILTER (WHERE feature = {sql_text(c)} AND target = {sql_text(t)} AND alpha = {float(a)!r}D)" for _, a, _, c, t in plan
        ]
        return F.expr(f"array({', '.join(cells)})")

    # One row per fold with two arrays.
    slopes, intercepts = fitted("slope"), fitted("intercept")
    return plan, held(fits.groupBy(FOLD).agg(slopes.alias("_slopes"), intercepts.alias("_intercepts")), what="fold fits")


def ridge_oof(
    df: DataFrame,
    features: Mapping[str, str],
    models: Mapping[str, float] | None = None,
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    key: str = KEY,
    clip: bool = True,
) -> DataFrame:
    """Long out-of-fold predictions of one-feature ridge models, for all configurations at once.

    ``features`` maps feature-set names to columns, ``models`` model names to penalties. The rows are scanned once for
    the fits (eager, a few numbers per fold) and once for scoring (lazy), so pass a stored feature table. 
    """
    models = models or {"Ridge": RIDGE_ALPHA}
    plan, per_fold = _fold_fits(df, features, models, targets, folds)
    # The position in the plan is unfolded as a plain number; names and inputs follow from it inside the same stage.
    target_at, feature_at = f"i % {len(targets)}", f"i div {len(targets)} % {len(features)}"

    def pick(position: str, columns: Sequence[str]) -> str:
        cases = " ".join(f"WHEN {j} THEN double({sql_name(c)})" for j, c in enumerate(columns))
        return f"CASE {position} {cases} END"

    def names(values: Sequence[str]) -> str:
        return "array(" + ", ".join(sql_text(v) for v in values) + ")[i]"

    value = "_slopes[i] * x + _intercepts[i]"
    return (
        df.join(per_fold, on=FOLD)
        .withColumn("i", F.expr(f"explode(sequence(0, {len(plan) - 1}))"))
        .selectExpr(
            f"{names([m for m, *_ in plan])} AS model",
            f"{names([n for _, _, n, *_ in plan])} AS feature_set",
            FOLD,
            key,
            f"{names([t for *_, t in plan])} AS target",
            f"{pick(target_at, targets)} AS y",
            f"{pick(feature_at, list(features.values()))} AS x",
            "i",
            "_slopes",
            "_intercepts",
        )
        .selectExpr(
            "model",
            "feature_set",
            FOLD,
            key,
            "target",
            "y",
            f"CASE WHEN {value} < 0 THEN 0D ELSE {value} END AS pred" if clip else f"{value} AS pred",
        )
    )


def ridge_side_by_side(
    df: DataFrame,
    features: Mapping[str, str],
    alpha: float = RIDGE_ALPHA,
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    key: str = KEY,
    clip: bool = True,
) -> DataFrame:
    """``(key, fold, target, y, <feature set>...)``: the predictions of ``ridge_oof`` for one model, a column per feature set.

    A row of the table has all of them, so they are beside each other without a shuffle. Keys that repeat stay apart.
    """
    _, per_fold = _fold_fits(df, features, {"": alpha}, targets, folds)

    def pred(i: int, column: str) -> str:
        value = f"_slopes[{i}] * double({sql_name(column)}) + _intercepts[{i}]"
        return f"CASE WHEN {value} < 0 THEN 0D ELSE {value} END" if clip else value

    cells = []
    for j, target in enumerate(targets):
        own = [f"{pred(i * len(targets) + j, column)} AS {sql_name(name)}" for i, (name, column) in enumerate(features.items())]
        cells.append(f"struct({sql_text(target)} AS target, double({sql_name(target)}) AS y, {', '.join(own)})")
    return df.join(per_fold, on=FOLD).selectExpr(sql_name(key), FOLD, f"inline(array({', '.join(cells)}))")


def fit_folds(
    df: DataFrame,
    factory: EstimatorFactory | None,
    targets: Sequence[str],
    folds: Sequence[int] | None = None,
    features: str = "features",
    parallelism: int = 4,
    per_job: JobFactory | None = None,
) -> dict[tuple[int, str], Model]:
    """Eager: one model per fold and target, trained outside the fold.

    ``per_job`` builds an estimator for a fold and target where the settings depend on them. An estimator with ``fit_targets``
    fits all targets of a fold at once. Jobs are submitted from a few threads, so small fits overlap. Pass a table that is stored or cached: it is read by
    every fit.
    """

    def fit(job: tuple[int, str]):
        fold, target = job
        estimator = (per_job(fold, target) if per_job else factory()).copy({})
        estimator.setFeaturesCol(features).setLabelCol(target).setPredictionCol("pred")
        return job, estimator.fit(training_rows(df, fold).select(features, target))

    folds = checked_folds(df, folds)
    if per_job is None and hasattr(factory(), "fit_targets"):

        def fit_fold(fold: int):
            return {(fold, t): m for t, m in fit_targets(factory, training_rows(df, fold), targets, features).items()}

        with ThreadPoolExecutor(parallelism) as pool:
            return {job: model for found in pool.map(fit_fold, [int(fold) for fold in folds]) for job, model in found.items()}
    jobs = [(int(fold), target) for fold in folds for target in targets]
    with ThreadPoolExecutor(parallelism) as pool:
        return dict(pool.map(fit, jobs))


def fit_targets(factory: EstimatorFactory, rows: DataFrame, targets: Sequence[str], features: str) -> dict[str, Model]:
    """Eager: a model for every target of the rows, all at once where the estimator has a way to."""

    def named(estimator: Estimator, target: str) -> Estimator:
        return estimator.copy({}).setFeaturesCol(features).setLabelCol(target).setPredictionCol("pred")

    first = factory()
    if hasattr(first, "fit_targets"):
        return named(first, targets[0]).fit_targets(rows.select(features, *targets), targets)
    return {t: named(factory() if i else first, t).fit(rows.select(features, t)) for i, t in enumerate(targets)}


def predict_folds(
    df: DataFrame,
    models: Mapping[tuple[int, str], Model],
    targets: Sequence[str],
    key: str = KEY,
    clip: bool = False,
) -> DataFrame:
    """Each row scored by the models of its own fold: ``(key, fold, target, y, pred)``.

    A row whose fold has no models is an error. The models of a fold run one after another over the fold's rows as added columns, which are then unfolded. Nothing
    is shuffled, unless trees are in tables: these meet the rows by part.
    """
    covered_folds(found_folds(df), {fold for fold, _ in models})
    if all(isinstance(model, forests.ForestModel) for model in models.values()):
        return forests.predict_folds(df, models, targets, key, clip)
    parts = []
    for fold in sorted({fold for fold, _ in models}):
        part = validation_rows(df, fold)
        for i, target in enumerate(targets):
            part = models[fold, target].copy({}).setPredictionCol(f"_pred_{i}").transform(part)
        cells = [
            F.struct(
                F.lit(t).alias("target"),
                F.col(t).cast("double").alias("y"),
                (clip_lower(f"_pred_{i}") if clip else F.col(f"_pred_{i}")).alias("pred"),
            )
            for i, t in enumerate(targets)
        ]
        parts.append(part.select(key, FOLD, F.inline(F.array(*cells))))
    return reduce(DataFrame.unionByName, parts)


def cross_validate(
    df: DataFrame,
    factory: EstimatorFactory,
    model: str,
    feature_set: str,
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    features: str = "features",
    key: str = KEY,
    clip: bool = False,
    parallelism: int = 4,
) -> tuple[DataFrame, dict[tuple[int, str], Model]]:
    """Out-of-fold predictions of one configuration, and its models. Fits are eager, scoring is lazy."""
    models = fit_folds(df, factory, targets, folds, features, parallelism)
    scored = predict_folds(df, models, targets, key, clip)
    return (
        scored.select(F.lit(model).alias("model"), F.lit(feature_set).alias("feature_set"), FOLD, key, "target", "y", "pred"),
        models,
    )


def experiment_grid(
    df: DataFrame,
    factories: Mapping[str, EstimatorFactory],
    feature_sets: Mapping[str, str],
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    key: str = KEY,
    clip: bool = False,
) -> tuple[DataFrame, list[tuple[str, str, float]]]:
    """Every model with every feature set: all out-of-fold predictions, and fit seconds per experiment."""
    parts, seconds = [], []
    for model, factory in factories.items():
        for name, column in feature_sets.items():
            start = time.perf_counter()
            predictions, _ = cross_validate(df, factory, model, name, targets, folds, column, key, clip)
            parts.append(predictions)
            seconds.append((model, name, time.perf_counter() - start))
    return reduce(DataFrame.unionByName, parts), seconds


LEDGER = "experiment string, model string, feature_set string, fold int, seconds double, predictions string"


def experiment_name(model: str, feature_set: str, column: str, fold: int, estimator: Estimator, targets: Sequence[str], data: str) -> str:
    """A digest of all that decides a fit: names, fold, targets, the estimator's class and settings, and the rows' version.

    Settings are named without the estimator's random identifier, so two estimators that are set alike are the same.
    """
    settings = sorted((param.name, str(value)) for param, value in estimator.extractParamMap().items())
    named = (model, feature_set, column, int(fold), type(estimator).__name__, settings, tuple(targets), data)
    return hashlib.sha256(repr(named).encode()).hexdigest()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """``(experiment, model, feature_set, fold, seconds, predictions)``; an absent folder is an empty ledger."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/done")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LEDGER)
    # Entries are written at the same time, each in a folder of its own.
    return spark.read.schema(LEDGER).parquet(f"{ledger}/done/*").dropDuplicates(["experiment"])


def restartable_grid(
    df: DataFrame,
    factories: Mapping[str, EstimatorFactory],
    feature_sets: Mapping[str, str],
    ledger: str,
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    key: str = KEY,
    clip: bool = False,
    parallelism: int = 4,
    data: str = "",
) -> tuple[DataFrame, DataFrame]:
    """Every model with every feature set, fold by fold, through a ledger: what is in it already is not fitted again.

    Returns all out-of-fold predictions and ``(model, feature_set, fold, seconds)``, seconds being those of the run that
    fitted it. An entry is written after its predictions, so a run that dies leaves whole entries or none, and the next run
    with the same ledger fits what is absent; a failing fit ends the run after the entries of others. ``data`` names the
    version of the rows. Entries are worked on by a few threads, each in a scheduler pool of its own, so that with fair
    scheduling small fits don't wait behind large ones.
    """
    spark = df.sparkSession
    chosen = checked_folds(df, folds)
    wanted = {}
    for model, factory in factories.items():
        for name, column in feature_sets.items():
            for fold in chosen:
                wanted[experiment_name(model, name, column, fold, factory(), targets, data)] = (model, name, column, int(fold))
    known = {r["experiment"] for r in read_ledger(spark, ledger).select("experiment").collect()}

    def run(job: tuple[int, tuple[str, tuple[str, str, str, int]]]) -> None:
        at, (experiment, (model, name, column, fold)) = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"experiments-{at % parallelism}")
        start = time.perf_counter()
        models = {(fold, t): m for t, m in fit_targets(factories[model], training_rows(df, fold), targets, column).items()}
        scored = predict_folds(validation_rows(df, fold), models, targets, key, clip)
        columns = [F.lit(model).alias("model"), F.lit(name).alias("feature_set"), FOLD, key, "target", "y", "pred"]
        path = f"{ledger}/predictions/{experiment}"
        scored.select(*columns).write.mode("overwrite").parquet(path)
        forests.discard(models.values())
        row = [(experiment, model, name, fold, time.perf_counter() - start, path)]
        spark.createDataFrame(row, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/done/{experiment}")

    jobs = [(e, job) for e, job in wanted.items() if e not in known]
    with ThreadPoolExecutor(parallelism) as pool:
        list(pool.map(inheritable_thread_target(spark)(run), enumerate(jobs)))
    entries = [r for r in read_ledger(spark, ledger).collect() if r["experiment"] in wanted]
    predictions = spark.read.parquet(*[r["predictions"] for r in entries])
    runtimes = spark.createDataFrame([(r["model"], r["feature_set"], r["fold"], r["seconds"]) for r in entries], "model string, feature_set string, fold int, seconds double")
    return predictions, runtimes
