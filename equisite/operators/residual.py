"""Explain need by share features and study what the model cannot explain.

The linear model needs two passes over the rows: cross products per fold, then leave-one-out
errors of every penalty. Its solve is part of the plan; nothing of it reaches the driver. The
forest grows its small nodes where their rows are (``forest``).
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equisite.functions.numbers import clip, safe_ratio
from equisite.operators.ranking import order_rank, top_n
from equisite.plans.session import CLEANUP_KEY, materialise, setting

FOLDS = 5
# 25 penalties, evenly spaced in the exponent from 1e-3 to 1e3.
PENALTIES = [10 ** (-3 + 6 * i / 24) for i in range(25)]


def share_features(df: DataFrame, features: dict[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """numerator / denominator per feature, clipped to [0, 1]; a zero denominator gives NULL."""
    for name, pair in features.items():
        missing = [c for c in pair if c not in df.columns]
        if missing:
            raise KeyError(f"column missing for {name}: {missing}")
    shares = [clip(safe_ratio(F.col(num).cast("double"), F.col(den).cast("double")), 0.0, 1.0).alias(name)
              for name, (num, den) in features.items()]
    return df.select(*keep, *shares)


def model_frame(target: DataFrame, features: DataFrame, names: Sequence[str], key: str = "unit_id") -> DataFrame:
    """Rows with a target and every feature."""
    return target.join(features, key).dropna(subset=list(names))


def assign_folds(frame: DataFrame, seed: int, folds: int = FOLDS) -> DataFrame:
    """Shuffled folds of equal size (within one), a pure function of (seed, unit_id).

    The shuffle order is a hash; its exact rank is taken by value ranges, so no task sorts all rows.
    """
    hashed = frame.withColumn("_h", F.expr(
        f"cast(conv(substring(md5(concat_ws('|', '{seed}', cast(unit_id as string))), 1, 13), 16, 10) as bigint)"))
    ranked = order_rank(hashed.withColumn("_all", F.lit(0)), ["_all"], "_h", "unit_id", "_place",
                        width=2 ** 32)
    return (ranked.withColumn("fold", ((F.col("_place") - 1) % folds).cast("int"))
            .drop("_h", "_all", "_place"))


def _moments(frame: DataFrame, names: Sequence[str], folds: int) -> DataFrame:
    """One row per split: sums of the products of (1, features, y) over the rows of all other folds.

    A partial aggregate of the size of the feature list; the splits take it from the total.
    """
    cols = ["1D", *names, "y"]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    own = frame.groupBy("fold").agg(*[F.expr(f"sum({cols[i]} * {cols[j]})").alias(f"m_{i}_{j}") for i, j in pairs])
    total = own.agg(*[F.sum(f"m_{i}_{j}").alias(f"t_{i}_{j}") for i, j in pairs])
    splits = frame.sparkSession.range(folds).select(F.col("id").cast("int").alias("split"))
    both = splits.join(own, F.col("split") == F.col("fold"), "left").crossJoin(F.broadcast(total))
    return both.select("split", *[(F.col(f"t_{i}_{j}") - F.coalesce(f"m_{i}_{j}", F.lit(0.0))).alias(f"m_{i}_{j}") for i, j in pairs])


def _standardised(moments: DataFrame, k: int) -> DataFrame:
    """(split, n, mean_y, mean, sd, gram, crossed) of standardised features; one that does not vary keeps its scale."""
    n, mean_y = F.col("m_0_0"), F.col(f"m_0_{k + 1}") / F.col("m_0_0")
    mean = [F.col(f"m_0_{i + 1}") / n for i in range(k)]

    def cov(i: int, j: int) -> Column:
        return F.col(f"m_{min(i, j) + 1}_{max(i, j) + 1}") / n - mean[i] * mean[j]
    sd = [F.sqrt(F.greatest(cov(i, i), F.lit(0.0))) for i in range(k)]
    scaled = moments.select("*", *[F.when(sd[i] < 1e-12, 1.0).otherwise(sd[i]).alias(f"sd_{i}") for i in range(k)])
    gram = F.array(*[F.array(*[n * cov(i, j) / (F.col(f"sd_{i}") * F.col(f"sd_{j}")) for j in range(k)]) for i in range(k)])
    crossed = F.array(*[n * (F.col(f"m_{i + 1}_{k + 1}") / n - mean[i] * mean_y) / F.col(f"sd_{i}") for i in range(k)])
    return scaled.select("split", n.alias("n"), mean_y.alias("mean_y"), F.array(*mean).alias("mean"),
                         F.array(*[F.col(f"sd_{i}") for i in range(k)]).alias("sd"), gram.alias("gram"), crossed.alias("crossed"))


def _inverse(matrix: str, k: int) -> str:
    """Inverse of a positive definite k x k array of rows, as SQL text.

    Gauss-Jordan elimination over [matrix | identity]. A pivot of such a matrix is never zero, so rows are not exchanged.
    """
    wide = f"transform({matrix}, (row, r) -> concat(row, transform(sequence(0, {k - 1}), c -> IF(c = r, 1.0D, 0.0D))))"
    step = "transform(m, (row, r) -> transform(row, (v, c) -> IF(r = p, v / m[p][p], v - row[p] * m[p][c] / m[p][p])))"
    return f"transform(aggregate(sequence(0, {k - 1}), {wide}, (m, p) -> {step}), row -> slice(row, {k + 1}, {k}))"


def _solved(frame: DataFrame, names: Sequence[str], folds: int, penalties: Sequence[float]) -> DataFrame:
    """One row per split and penalty: the inverse of gram + penalty and the coefficients of the standardised features."""
    k = len(names)
    grid = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(float(p)).alias("penalty")) for i, p in enumerate(penalties)]))
    rows = _standardised(_moments(frame, names, folds), k).withColumn("g", grid).select("*", "g.*").drop("g")
    ridged = "transform(gram, (row, r) -> transform(row, (v, c) -> IF(r = c, v + penalty, v)))"
    rows = rows.withColumn("inverse", F.expr(_inverse(ridged, k))).drop("gram")
    return rows.withColumn("beta", F.expr("transform(inverse, row -> aggregate(zip_with(row, crossed, (a, b) -> a * b), 0.0D, (s, v) -> s + v))"))


def ridge_models(frame: DataFrame, names: Sequence[str], folds: int = FOLDS,
                 penalties: Sequence[float] = PENALTIES) -> DataFrame:
    """(split, penalty, intercept, weights): per split the penalty with the least leave-one-out error (ties: the smaller place).

    The solve is an expression over a matrix of the size of the feature list. Its ``folds`` x ``penalties`` models, and
    then the chosen ones, are written when this is called, since later steps read them several times; the errors meet the
    rows as a broadcast of the models, and only partial sums are shuffled.
    """
    k = len(names)
    solved = materialise(_solved(frame, names, folds, penalties), "ridge-models")
    z = [(F.col(f) - F.col("mean")[i]) / F.col("sd")[i] for i, f in enumerate(names)]
    met = frame.select("fold", "y", *names).join(F.broadcast(solved), F.col("fold") != F.col("split"))
    met = met.select("split", "place", "n", "mean_y", "beta", "inverse", "y", *[v.alias(f"z{i}") for i, v in enumerate(z)])
    fitted = reduce(Column.__add__, [F.col("beta")[i] * F.col(f"z{i}") for i in range(k)], F.col("mean_y"))
    squares = [F.col("inverse")[i][j] * F.col(f"z{i}") * F.col(f"z{j}") * (1.0 if i == j else 2.0) for i in range(k) for j in range(i, k)]
    leverage = reduce(Column.__add__, squares, 1.0 / F.col("n"))
    error = (F.col("y") - fitted) / (1.0 - leverage)
    errors = met.groupBy("split", "place").agg(F.sum(error * error).alias("sse"))
    best = errors.groupBy("split").agg(F.min(F.struct("sse", "place")).alias("b")).select("split", F.col("b.place").alias("place"))
    weights = F.zip_with("beta", "sd", lambda b, s: b / s)
    shift = F.aggregate(F.zip_with("weights", "mean", lambda w, m: w * m), F.lit(0.0), lambda s, v: s + v)
    chosen = (solved.join(F.broadcast(best), ["split", "place"]).withColumn("weights", weights)
              .select("split", "penalty", (F.col("mean_y") - shift).alias("intercept"), "weights"))
    return materialise(chosen, "ridge-chosen")


def ridge_predictions(frame: DataFrame, names: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """Out-of-fold predictions: no unit is predicted by a model that saw it."""
    models = ridge_models(frame, names, folds)
    line = reduce(Column.__add__, [F.col("weights")[i] * F.col(f) for i, f in enumerate(names)], F.col("intercept"))
    return frame.join(F.broadcast(models), F.col("fold") == F.col("split"), "left").select(
        "unit_id", "fold", "y", line.alias("predicted"), "penalty")


def baseline_predictions(frame: DataFrame, feature: str | None = None, folds: int = FOLDS) -> DataFrame:
    """Out-of-fold predictions without a fit on the driver: the mean of the other folds, or the least-squares line in
    one feature through them. One partial aggregate per fold, joined back by fold."""
    x, y = F.col(feature) if feature else F.lit(0.0), F.col("y")
    sums = frame.groupBy("fold").agg(F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
                                     F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    total = sums.agg(*[F.sum(c).alias(f"t_{c}") for c in ("n", "sx", "sy", "sxx", "sxy")])
    n, sx, sy, sxx, sxy = (F.col(f"t_{c}") - F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy"))
    slope = F.coalesce((n * sxy - sx * sy) / F.nullif(n * sxx - sx * sx, F.lit(0.0)), F.lit(0.0)) if feature else F.lit(0.0)
    lines = sums.crossJoin(F.broadcast(total)).select("fold", slope.alias("_slope"), ((sy - slope * sx) / F.nullif(n, F.lit(0))).alias("_base"))
    return frame.join(F.broadcast(lines), "fold").select(
        "unit_id", "fold", "y", (F.col("_base") + F.col("_slope") * x).alias("predicted"))


def _forest(names: Sequence[str], trees: int, max_depth: int, seed: int):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from equisite.operators.forest import GrownForest
    forest = GrownForest(trees=trees, max_depth=max_depth, least=3, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=list(names), outputCol="features"), forest])


TREES, MAX_DEPTH = 500, 30
"""With three rows per leaf trees end before depth 30."""


def forest_models(frame: DataFrame, names: Sequence[str], folds: int = FOLDS, trees: int = TREES,
                  max_depth: int = MAX_DEPTH, seed: int = 42):
    """Random forests with at least three rows per leaf: one per split, and one on every row.

    The splits are those of ``fold``; all fits run side by side when this is called, and predictions and importance share them.
    Candidate cuts are 32 quantile bins of a feature.
    """
    from pyspark import inheritable_thread_target
    from pyspark.ml.tuning import CrossValidatorModel
    spark = frame.sparkSession
    wrong = F.raise_error(F.concat(F.lit(f"fold numbers must be in range [0, {folds}): "), F.coalesce(F.col("fold").cast("string"), F.lit("null"))))
    known = frame.withColumn("fold", F.when(F.col("fold").between(0, folds - 1), F.col("fold")).otherwise(wrong.cast("int")))

    def fitted(split: int):
        return _forest(names, trees, max_depth, seed).fit(known.filter(F.col("fold") != split))
    # the fits write side by side, each with this setting: it must not change under the others
    with setting(spark, CLEANUP_KEY, "true"), ThreadPoolExecutor(folds + 1) as pool:
        *own, every = pool.map(inheritable_thread_target(spark)(fitted), [*range(folds), folds])
    return CrossValidatorModel(every, subModels=[[m] for m in own])


def forest_predictions(frame: DataFrame, models) -> DataFrame:
    """Out-of-fold predictions of fitted ``forest_models``: no unit is predicted by a forest that saw it."""
    parts = [own[0].transform(frame.filter(F.col("fold") == fold)).select("unit_id", "fold", "y", "predicted")
             for fold, own in enumerate(models.subModels)]
    return reduce(DataFrame.unionByName, parts)


def feature_importance(frame: DataFrame, names: Sequence[str], models) -> DataFrame:
    """Importance in the forest on every row, for interpretation only; one row per feature."""
    shares = [float(v) for v in models.bestModel.stages[-1].featureImportances.toArray()]
    table = ", ".join(f"('{n}', {v!r}D)" for n, v in zip(names, shares))
    return frame.sparkSession.sql(f"SELECT * FROM VALUES {table} AS t(feature, importance) ORDER BY importance DESC")


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """R2 and mean absolute error of each fold, from sums."""
    e = F.col("y") - F.col("predicted")
    return predictions.groupBy("fold").agg(
        F.count("*").alias("n"),
        (1 - F.sum(e * e) / F.nullif(F.var_pop("y") * F.count("*"), F.lit(0.0))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"))


def cv_metrics(models: dict[str, DataFrame]) -> DataFrame:
    """Mean and (population) deviation of R2 and mean error per model; the best mean R2 is flagged."""
    parts = [fold_metrics(p).agg(F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_sd"),
                                 F.avg("mae").alias("mae")).withColumn("model", F.lit(name))
             for name, p in models.items()]
    scores = reduce(DataFrame.unionByName, parts)
    best = scores.agg(F.max_by("model", "r2_mean").alias("best_model"))
    return scores.crossJoin(F.broadcast(best)).select(
        "model", "r2_mean", "r2_sd", "mae", (F.col("model") == F.col("best_model")).alias("is_best"))


def best_model(models: dict[str, DataFrame]) -> str:
    return cv_metrics(models).filter("is_best").head()["model"]


def residuals(predictions: DataFrame, selected: DataFrame) -> DataFrame:
    """Residual, its z-score over all units, and whether the allocation chose the unit.

    Mean and deviation are one aggregate row joined back, not a window over everything.
    """
    rows = predictions.withColumn("residual", F.col("y") - F.col("predicted"))
    stats = rows.agg(F.avg("residual").alias("_mean"), F.stddev_samp("residual").alias("_sd"))
    chosen = selected.select("unit_id", F.lit(True).alias("allocated"))
    return (rows.crossJoin(F.broadcast(stats)).join(chosen, "unit_id", "left")
            .withColumn("residual_z", (F.col("residual") - F.col("_mean")) / F.nullif("_sd", F.lit(0.0)))
            .withColumn("allocated", F.coalesce("allocated", F.lit(False))).drop("_mean", "_sd"))


def extremes(resid: DataFrame, worst: int = 15, best: int = 10) -> DataFrame:
    """The units furthest above and below expectation."""
    over = top_n(resid, "residual", worst, "unit_id").withColumn("side", F.lit("worse"))
    under = top_n(resid, "residual", best, "unit_id", ascending=True).withColumn("side", F.lit("better"))
    return over.unionByName(under)
