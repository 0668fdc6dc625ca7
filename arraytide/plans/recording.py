"""Logger lines to a physical record and its reconciliation, every station in one plan."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import axis

CHANNELS = ("hx", "hy", "hz", "ex", "ey")


def record(samples: DataFrame, arms: DataFrame | None = None, **gains) -> DataFrame:
    """(site, i, hx..ey) from (site, chan, file, pos, value): the later file wins, channels side by side, units applied.

    One shuffle on (site, pos) places all five channels at once; `arms` is (site, dipole_n_m, dipole_e_m).
    """
    last = lambda ch: F.max_by(F.when(F.col("chan") == ch, F.col("value")), F.when(F.col("chan") == ch, F.struct("file", "pos")))
    d = samples.groupBy("site", F.col("pos").alias("i")).agg(*[last(ch).alias(ch) for ch in CHANNELS])
    if arms is None:
        return d
    return axis.unit_gains(d.join(arms, "site", "left"), **gains).select("site", "i", *CHANNELS)


def reconciliation(samples: DataFrame, files_found: DataFrame) -> DataFrame:
    """Per station and channel what was read and placed against the files found, with the verdict of each channel.

    `files_found` is (site, chan, files_found).
    """
    per = axis.reconcile(samples, ["site", "chan"], "pos").drop("verdict")
    read = samples.groupBy("site", "chan").agg(F.countDistinct("file").alias("files_read"))
    d = files_found.join(per, ["site", "chan"], "left").join(read, ["site", "chan"], "left")
    d = d.withColumn("files_read", F.coalesce("files_read", F.lit(0))).withColumn("files_unplaced", F.lit(0))
    good = ((F.col("samples_placed") == F.col("samples_read")) & (F.col("overlap_samples") == 0) & (F.col("files_read") == F.col("files_found")))
    return d.withColumn("verdict", F.when(F.coalesce(good, F.lit(False)), "PASS").otherwise("FAIL"))
