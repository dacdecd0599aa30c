"""Models beyond means: exponential smoothing with level, trend and season, one regression over all series, isolation trees."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import FEATURES, default_holdout, prepared

PERIOD = 7
GRID = [(a, b, g) for a in (0.05, 0.1, 0.2, 0.4, 0.7) for b in (0.0, 0.05, 0.2) for g in (0.0, 0.1, 0.3)]  # smoothing of level, trend and season that are tried
TREES, SUBSET = 100, 256
_ERRORS = "series string, fold int, test_start date, test_end date, model string, mae double, mse double, rmse double, mape double, covered double"


def smoothed(y: np.ndarray, period: int = PERIOD, grid: list[tuple[float, float, float]] = GRID) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Level, trend, season (a row each) and squared one-step error of every setting after the whole series, and the settings.

    The recursion starts from the first period's mean, the mean change between the first two periods, and what each of the
    first days has above its mean. A series under two periods has no trend and season to start from: only its level moves.
    """
    y, (a, b, g) = np.asarray(y, dtype=float), (np.array(c) for c in zip(*grid, strict=True))
    if len(y) < 2 * period:
        level, error = np.full(len(grid), y[0]), np.zeros(len(grid))
        for v in y[1:]:
            error += (v - level) ** 2
            level = level + a * (v - level)
        return level, np.zeros(len(grid)), np.zeros((len(grid), period)), error, np.column_stack([a, b, g])
    first = y[:period].mean()
    level, trend = np.full(len(grid), first), np.full(len(grid), (y[period : 2 * period].mean() - first) / period)
    season = np.tile(y[:period] - first, (len(grid), 1))
    error = np.zeros(len(grid))
    for t in range(period, len(y)):
        s = season[:, t % period]
        miss = y[t] - (level + trend + s)
        error += miss**2
        level = level + trend + a * miss
        trend = trend + a * b * miss
        season[:, t % period] = s + g * (1 - a) * miss
    return level, trend, season, error, np.column_stack([a, b, g])


def holt_winters(y: np.ndarray, horizon: int, z: float = 1.28155) -> tuple[np.ndarray, np.ndarray]:
    """The forecast of the setting with the least one-step error, and half the width of its 80 % intervals (for other z, other shares)."""
    level, trend, season, error, grid = smoothed(y)
    k = int(np.argmin(error))
    h = np.arange(1, horizon + 1)
    steps = max(1, len(y) - (PERIOD if len(y) >= 2 * PERIOD else 1))
    a, b, g = grid[k]
    later = a * (1 + h[:-1] * b) + g * (1 - a) * (h[:-1] % PERIOD == 0)  # how an error lasts
    width = z * np.sqrt(error[k] / steps * (1 + np.append(0, np.cumsum(later**2))))
    return level[k] + trend[k] * h + season[k][(len(y) + h - 1) % PERIOD], width


def smooth_forecast(history: DataFrame, horizon: int = 7) -> DataFrame:
    """series, forecast_date, model, predicted_revenue, low, high of each series' smoothing; negatives become 0."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("date")
        p, width = holt_winters(rows["revenue"].to_numpy(float), horizon)
        ahead = pd.date_range(pd.Timestamp(rows["date"].iloc[-1]) + pd.Timedelta(days=1), periods=horizon)
        return pd.DataFrame({"series": key[0], "forecast_date": ahead.date, "model": "holt_winters", "predicted_revenue": np.clip(p, 0, None), "low": np.clip(p - width, 0, None), "high": np.clip(p + width, 0, None)})

    return prepared(history).groupBy("series").applyInPandas(one, "series string, forecast_date date, model string, predicted_revenue double, low double, high double")


def folds(history: DataFrame, holdout: int | None = None, splits: int = 3) -> DataFrame:
    """Each series' rows once for each of its folds, with `test` marking the days that the fold is scored on."""
    by_series = Window.partitionBy("series")
    rows = prepared(history).withColumn("at", F.row_number().over(by_series.orderBy("date")) - 1).withColumn("n", F.count("*").over(by_series))
    rows = rows.filter("n >= 5").withColumn("h", F.expr(default_holdout()) if holdout is None else F.lit(holdout))
    rows = rows.withColumn("k", F.expr(f"least({splits}, CAST(floor((n - greatest(5, h)) / h) AS INT))")).filter("k >= 1")
    each = rows.withColumn("fold", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("cut", F.expr("n - (k - fold) * h"))
    return each.filter("at < cut + h").withColumn("test", F.col("at") >= F.col("cut"))


def smooth_backtest(history: DataFrame, holdout: int | None = None, splits: int = 3) -> DataFrame:
    """Errors of the smoothing on each fold, and the share of days within its intervals; a group is one fold of one series."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("date")
        seen, want = (rows.loc[rows["test"] == t, "revenue"].to_numpy(float) for t in (False, True))
        p, width = holt_winters(seen, len(want))
        e, days = np.abs(want - np.clip(p, 0, None)), rows.loc[rows["test"], "date"]
        mse = float(np.mean(e**2))
        return pd.DataFrame([(*key, days.min(), days.max(), "holt_winters", e.mean(), mse, math.sqrt(mse), float(np.mean(e / np.maximum(want, 1))) * 100, float(np.mean(np.abs(want - p) <= width)))], columns=[c.split()[0] for c in _ERRORS.split(", ")])

    return folds(history, holdout, splits).groupBy("series", "fold").applyInPandas(one, _ERRORS)


LAGS = ("week", "fortnight", "mean", "slope", "weekend")


def _lagged(rows: DataFrame, horizon: int = 7) -> DataFrame:
    """What is known `horizon` days ahead of each day: the values 7 and 14 days before, the mean of the 7 days up to then, and its change."""
    w = Window.partitionBy("series").orderBy("date")
    mean = lambda a, b: F.avg("revenue").over(w.rowsBetween(-b, -a))
    return rows.withColumns({"week": F.lag("revenue", 7).over(w), "fortnight": F.lag("revenue", 14).over(w), "mean": mean(horizon, horizon + 6), "slope": mean(horizon, horizon + 6) - mean(horizon + 7, horizon + 13), "weekend": (F.weekday("date") >= 5).cast("double")})


def pooled_forecast(history: DataFrame, ridge: float = 0.1) -> DataFrame:
    """series, forecast_date, model, predicted_revenue of the 7 days after each series, by one regression over the days of all series.

    Series are scaled by their mean, so that large and small ones count alike. Days without a full fortnight and a week
    before them teach nothing; where a series lacks these before its forecast, they count as its mean.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = prepared(history).select("series", "date", "revenue")
    scale = rows.groupBy("series").agg(F.greatest(F.avg("revenue"), F.lit(1e-9)).alias("scale"), F.max("date").alias("last"))
    ahead = scale.select("series", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", 7))).alias("date"), F.lit(None).cast("double").alias("revenue"))
    x = _lagged(rows.unionByName(ahead)).join(scale, "series")
    x = x.withColumns({c: F.col(c) / F.col("scale") for c in ("week", "fortnight", "mean", "slope")} | {"label": F.col("revenue") / F.col("scale")})
    vectors = VectorAssembler(inputCols=list(LAGS), outputCol="features")
    train = vectors.transform(x.dropna(subset=[*LAGS, "label"]))
    given = vectors.transform(x.filter("date > last").fillna(1.0, ["week", "fortnight", "mean"]).fillna(0.0, ["slope"]))
    if train.isEmpty():
        predicted = given.withColumn("prediction", F.lit(1.0))
    else:
        predicted = LinearRegression(regParam=ridge, elasticNetParam=0.0).fit(train).transform(given)
    return predicted.select("series", F.col("date").alias("forecast_date"), F.lit("pooled_lags").alias("model"), F.greatest(F.col("prediction") * F.col("scale"), F.lit(0.0)).alias("predicted_revenue"))


def _path_length(n: np.ndarray | float) -> np.ndarray:
    """The mean depth of a search that fails among n points."""
    n = np.asarray(n, dtype=float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, seed: int) -> list[list[float]]:
    """An isolation tree as rows: feature (-1: leaf), cut, left child, right child, depth plus what the leaf's points would add."""
    r, limit, nodes = np.random.default_rng(seed), math.ceil(math.log2(max(len(x), 2))), []

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([-1.0, 0.0, 0.0, 0.0, float(depth + _path_length(len(rows)))])
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(x.shape[1]),) * 2
        open_ = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and len(open_):
            f = int(r.choice(open_))
            cut = float(r.uniform(low[f], high[f]))
            left = rows[:, f] < cut
            nodes[at][:4] = [float(f), cut, float(add(rows[left], depth + 1)), float(add(rows[~left], depth + 1))]
        return at

    add(x, 0)
    return nodes


def depths(x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = nodes[at, 0] >= 0
        if not inner.any():
            return nodes[at, 4]
        f = nodes[at, 0].astype(np.int64)
        left = x[np.arange(len(x)), np.maximum(f, 0)] < nodes[at, 1]
        at = np.where(inner, np.where(left, nodes[at, 2], nodes[at, 3]).astype(np.int64), at)


def isolation_scores(history: DataFrame, trees: int = TREES, subset: int = SUBSET, seed: int = 0, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """history with isolation_score (0 to 1; the easier a day is to set apart from the others of its series, the higher).

    A tree is grown in a group of its own from the `subset` rows whose hashes with its number are least, of all series,
    each series scaled by its mean and spread; the trees (at most 2 * subset nodes each) are broadcast to score all rows.
    """
    w = Window.partitionBy("series")
    z = {f"_z{i}": F.coalesce((F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - F.avg(F.coalesce(F.col(f).cast("double"), F.lit(0.0))).over(w)) / F.nullif(F.stddev_pop(F.coalesce(F.col(f).cast("double"), F.lit(0.0))).over(w), F.lit(0.0)), F.lit(0.0)) for i, f in enumerate(features)}
    scaled = history.withColumns(z)
    names, n = list(z), scaled.count()
    if not n:
        return history.withColumn("isolation_score", F.lit(0.0))
    size = min(n, subset)
    share = min(1.0, 2 * size / n + 20 / n)  # of the rows that a tree is offered, so that it has `size` of them all but surely
    offered = scaled.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(trees)))).withColumn("hash", F.pmod(F.xxhash64("series", "date", "tree", F.lit(seed)), F.lit(1 << 40)))
    offered = offered.filter(F.col("hash") < int(share * (1 << 40)))
    least = Window.partitionBy("tree").orderBy("hash", "series", "date")
    chosen = offered.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= size).select("tree", "place", *names)

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        return pd.DataFrame([(key[0], grow(rows[names].to_numpy(float), seed * 1_000_003 + int(key[0])))], columns=["tree", "nodes"])

    grown = chosen.groupBy("tree").applyInPandas(one, "tree int, nodes array<array<double>>").orderBy("tree").collect()  # trees times 2 * subset nodes
    forest = history.sparkSession.sparkContext.broadcast([np.array(t.nodes) for t in grown])
    usual = float(_path_length(size)) or 1.0

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        rows = x.to_numpy(float)
        return pd.Series(2.0 ** (-np.mean([depths(rows, t) for t in forest.value], axis=0) / usual))

    return scaled.withColumn("isolation_score", score(F.struct(*names))).drop(*names)


def isolation_anomalies(history: DataFrame, contamination: float = 0.05, trees: int = TREES, seed: int = 0) -> DataFrame:
    """series, date, the features, anomaly_score and anomaly_label (1: beyond the quantile of the series)."""
    d = isolation_scores(history, trees, seed=seed)
    cut = F.percentile("isolation_score", 1 - contamination).over(Window.partitionBy("series"))
    return d.select("series", "date", *FEATURES, F.col("isolation_score").alias("anomaly_score"), (F.col("isolation_score") > cut).cast("int").alias("anomaly_label"))


def isolation_stability(history: DataFrame, seeds: int = 5, contamination: float = 0.05, trees: int = TREES) -> DataFrame:
    """series, date, mean_score, std_score, flag_rate over forests of different seeds."""
    runs = None
    for seed in range(seeds):
        one = isolation_anomalies(history, contamination, trees, seed)
        runs = one if runs is None else runs.unionByName(one)
    return runs.groupBy("series", "date").agg(F.avg("anomaly_score").alias("mean_score"), F.stddev_pop("anomaly_score").alias("std_score"), F.avg("anomaly_label").alias("flag_rate"))
