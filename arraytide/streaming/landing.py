"""Files landing while a survey runs: each micro-batch rewrites only the partitions it touches.

`dropDuplicatesWithinWatermark` keeps the first row of a key and the rule here is that the later file wins, so
the batch is placed together with what the touched partitions already hold.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import axis
from ..operators.blocks import block_of
from ..sources.survey import on_store

HOUR = 3600


def land(stream: DataFrame, root: str, checkpoint: str, keys: list[str], pos: str, values: list[str], order: list[str],
         partition: int = HOUR, available_now: bool = True) -> StreamingQuery:
    """Place a stream of samples into a store partitioned by (keys, part); later rows by `order` win.

    A batch reads back only its own partitions. They are written under the batch's own version folder first and
    then replaced dynamically, so re-running a batch after a failure gives the same partitions.
    """
    cols = [*keys, pos, *values, *order]

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.select(*cols).withColumn("part", block_of(pos, partition))
        touched = new.select(*keys, "part").distinct()
        both = new
        if on_store(spark, root):
            # the batch's own types: a key such as '007' stays text; the span of its parts prunes folders
            span = touched.agg(F.min("part").alias("lo"), F.max("part").alias("hi")).first()
            held = spark.read.schema(new.schema).parquet(root).where(F.col("part").between(span["lo"], span["hi"])) if span["lo"] is not None else new.limit(0)
            both = held.select(*cols, "part").join(touched, [*keys, "part"], "left_semi").unionByName(new)
        placed = axis.place(both, [*keys, "part"], pos, [*values, *order], order).drop("n_read")
        staged = f"{checkpoint}/staged/{batch_id}"
        placed.write.mode("overwrite").parquet(staged)
        (spark.read.parquet(staged).repartition(*keys, "part").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*keys, "part").parquet(root))

    w = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{checkpoint}/offsets")
    return (w.trigger(availableNow=True) if available_now else w).start()


def overlap_counter(stream: DataFrame, ts: str, keys: list[str], lateness: str = "1 hour", window: str = "1 hour") -> DataFrame:
    """Samples, positions and overlaps per station and hour, counted exactly: first per position, then per window.

    Rows later than the watermark go to batch repair.
    """
    per = stream.withWatermark(ts, lateness).groupBy(F.window(ts, window).alias("window"), *keys, F.unix_micros(ts).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    both = per.groupBy("window", *keys).agg(F.sum("_n").alias("samples_read"), F.count(F.lit(1)).alias("positions"))
    return both.withColumn("overlaps", F.col("samples_read") - F.col("positions"))
