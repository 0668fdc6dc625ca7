"""Tumbling and sliding quality windows over a stream of samples, with event time and a watermark."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tumbling(stream: DataFrame, ts: str, keys: list[str], value: str, width: str = "10 minutes", lateness: str = "30 minutes",
             whole: int | None = None) -> DataFrame:
    """Mean, extremes and count of every chunk; only whole chunks where `whole` gives their sample count."""
    d = (stream.withWatermark(ts, lateness).groupBy(F.window(ts, width), *keys)
         .agg(F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n"), F.stddev_pop(value).alias("std")))
    d = d.select(F.col("window.start").alias("t_start"), F.col("window.end").alias("t_end"), *keys, "mean", "low", "high", "n", "std")
    return d if whole is None else d.where(F.col("n") == whole)


def sliding_correlation(stream: DataFrame, ts: str, keys: list[str], x: str, y: str, width: str = "60 minutes",
                        step: str = "30 minutes", lateness: str = "60 minutes") -> DataFrame:
    """Squared correlation of two channels over sliding windows, from mergeable sums."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    d = (stream.withWatermark(ts, lateness).groupBy(F.window(ts, width, step), *keys)
         .agg(F.covar_pop(a, b).alias("c"), F.var_pop(a).alias("va"), F.var_pop(b).alias("vb"), F.count(a).alias("n")))
    return d.select(F.col("window.start").alias("t_start"), *keys, F.try_divide(F.col("c") * F.col("c"), F.col("va") * F.col("vb")).alias("r2"), "n")


def sessions(stream: DataFrame, ts: str, keys: list[str], gap: str = "10 minutes", lateness: str = "30 minutes") -> DataFrame:
    """Runs of samples closer than `gap`: the streaming form of gaps and islands."""
    d = stream.withWatermark(ts, lateness).groupBy(F.session_window(ts, gap), *keys).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return d.select(*keys, "first", "last", "n")
