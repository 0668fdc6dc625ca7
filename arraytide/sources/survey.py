"""Survey tables as text, comparison tables, arm lengths, records and the response ledger."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import names


def read_text_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with every column text, an empty cell '' and not NULL; a missing file is an empty table."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not on_store(spark, path):
        return spark.createDataFrame([], schema)
    d = spark.read.option("header", True).option("inferSchema", False).option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    return d.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in d.columns])


def on_store(spark: SparkSession, path: str) -> bool:
    """Whether a path is there on the file system that the session reads it from."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def is_stub(table: DataFrame) -> bool:
    """A header and no row."""
    return table.isEmpty()


def read_reference(table: DataFrame, columns: dict[str, str], select: dict[str, str] | None = None) -> DataFrame:
    """A comparison table with its rows filtered and its columns renamed to ours; columns it lacks are left out."""
    d = table
    for c, v in (select or {}).items():
        if c in d.columns:
            d = d.where(F.col(c).cast("string") == str(v))
    return d.select(*[F.col(theirs).alias(ours) for ours, theirs in columns.items() if theirs in d.columns])


def arm_lengths(stations: DataFrame, sheet: DataFrame, default_m: float | None, reason: str, key: str = "site") -> DataFrame:
    """Arm lengths from the sheet, else `assume:<m>` with the reason, else nothing."""
    s = sheet.select(key, F.col("dipole_n_m").alias("_n"), F.col("dipole_e_m").alias("_e"), F.col("source").alias("_s"))
    d = stations.select(key).join(s, key, "left")
    assumed = F.lit("" if default_m is None else "assume:%g" % default_m)
    pick = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(assumed)
    src = F.when(F.coalesce(F.col("_n"), F.lit("")) != "", F.col("_s")).otherwise(F.lit("" if default_m is None else reason))
    return d.select(key, pick("_n").alias("dipole_n_m"), pick("_e").alias("dipole_e_m"), src.alias("dipole_source"))


def default_length(per_instrument: DataFrame, survey_default: Column | None, instrument: str = "instrument") -> DataFrame:
    """The survey-wide default where there is one, else the instrument's own."""
    own = F.col("value")
    return per_instrument.select(instrument, F.coalesce(survey_default, own).alias("metres") if survey_default is not None else own.alias("metres"))


def with_text_partitions(spark: SparkSession, root: str, text: list[str]) -> DataFrame:
    """A partitioned table whose named partition columns stay text: '007' is not the number 7."""
    found = spark.read.parquet(root).schema
    typed = T.StructType([T.StructField(f.name, T.StringType() if f.name in text else f.dataType) for f in found])
    return spark.read.schema(typed).parquet(root)


def read_record(spark: SparkSession, root: str, rate_hz: int, sites: list[str] | None = None, channels: list[str] | None = None) -> DataFrame:
    """A record from the partitioned store: station and rate prune partitions, the channel list prunes columns."""
    d = with_text_partitions(spark, root, ["site"]).where(F.col("rate_hz") == rate_hz)
    d = d if sites is None else d.where(F.col("site").isin(*sites))
    return d if channels is None else d.select("site", "rate_hz", "i", *channels)


def write_record(samples: DataFrame, root: str, block: int = 86_400) -> None:
    """Write records partitioned by rate and station, replacing only the partitions that are written.

    A station is spread over as many files as it has blocks, so one long record is not one task or one file.
    """
    from ..operators.blocks import block_of
    d = samples.withColumn("_b", block_of("i", block * 30)).repartition("rate_hz", "site", "_b").sortWithinPartitions("site", "i").drop("_b")
    d.write.partitionBy("rate_hz", "site").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def to_build(wanted: DataFrame, store: DataFrame, keys: list[str]) -> DataFrame:
    """What is not in the store yet."""
    return wanted.join(store.select(*keys).distinct(), keys, "left_anti")


def find_responses(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger rows with the path the naming rule gives them and whether that file is there.

    `files` is (path, length). Paths are relative: <site>/<run>_<stamp>/<name>.edi.
    """
    n = names.response_name(F.col("site"), F.col("kind"), F.col("rate_hz"), F.col("selection"), F.col("params"))
    d = ledger.withColumn("path", F.concat_ws("/", "site", F.concat_ws("_", "run", "stamp"), F.concat(n, F.lit(".edi"))))
    return d.join(files.select("path", F.lit(True).alias("on_disk")), "path", "left").withColumn("on_disk", F.coalesce("on_disk", F.lit(False)))


def unledgered(files: DataFrame, found: DataFrame) -> DataFrame:
    """Response files no ledger row names."""
    return files.join(found.select("path"), "path", "left_anti")


def all_responses(ledger: DataFrame, forms: DataFrame, strays: DataFrame, keys: list[str]) -> DataFrame:
    """Ledger, forms and strays as one list, the ledger's row before a form's before a stray's."""
    tag = lambda d, k: d.withColumn("_o", F.lit(k))
    u = tag(ledger, 0).unionByName(tag(forms, 1), allowMissingColumns=True).unionByName(tag(strays, 2), allowMissingColumns=True)
    rest = [c for c in u.columns if c not in (*keys, "_o")]
    return u.groupBy(*keys).agg(F.min_by(F.struct(*rest), "_o").alias("_r")).select(*keys, "_r.*")
