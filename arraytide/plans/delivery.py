"""All responses of a survey to delivered rows: tests, choice, trim to the held band and the merge, as one plan."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import curves, readings


def deliver(tf: DataFrame, station: list[str], name: str, kind: str, **tests) -> DataFrame:
    """Rows of the response of record of every station and component, inside the band that curve holds.

    `station` names the columns a choice is made within and ends in `comp`; a component without a response of
    record delivers nothing.
    """
    table = readings.readings_table(tf, station, name, kind, **tests)
    chosen = readings.response_of_record(table, station, name).where(F.col("response") != "none").select(*station, F.col("response").alias(name))
    rows = tf.join(chosen, [*station, name], "left_semi")
    bands = table.join(chosen, [*station, name], "left_semi").select(*station, F.col("held_lo_s").alias("lo"), F.col("held_hi_s").alias("hi"))
    site = [c for c in station if c != "comp"]
    return curves.trim(rows, site, bands)


def common_grid(tf: DataFrame, keys: list[str]) -> DataFrame:
    """The optional copy on ten periods a decade; never the delivered rows themselves."""
    per = F.explode(F.array(*[F.lit(p) for p in curves.resample_grid()]))
    targets = tf.select(*keys, "comp").distinct().withColumn("period", per)
    return curves.on_periods(tf, targets, keys)
