"""The one-second observatory archive: coverage by day, what is missing, parsing a landed day, consolidation."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DAY = 86_400
FILL = 88_888.0


def load(spark: SparkSession, paths: list[str], t0: int, n: int) -> DataFrame:
    """Archive rows of [t0, t0 + n): the time filter and the column list both reach the Parquet scan."""
    lo, hi = F.timestamp_seconds(F.lit(t0)), F.timestamp_seconds(F.lit(t0 + n))
    d = spark.read.parquet(*paths).where((F.col("DateTime") >= lo) & (F.col("DateTime") < hi))
    num = lambda c: F.when(~F.isnan(c), F.col(c))
    return d.select(F.unix_seconds("DateTime").alias("i"), num("BX").alias("hx"), num("BY").alias("hy"), num("BZ").alias("hz"), "pub").withColumn(
        "mask", F.col("hx").isNotNull() & F.col("hy").isNotNull() & F.col("hz").isNotNull())


def day_coverage(seconds: DataFrame, keys: list[str], sec: str, lo: int | None = None, hi: int | None = None, need: float = 0.5 * DAY) -> DataFrame:
    """Samples of every calendar day, absent days included; a day is present with at least half of it.

    Counted exactly from one column, days without rows from a calendar of one row per day.
    """
    day = ((F.col(sec) - F.pmod(F.col(sec), F.lit(DAY))) / DAY).cast("bigint")
    n = seconds.groupBy(*keys, day.alias("day")).agg(F.count(F.lit(1)).alias("n_samples"))
    span = n.groupBy(*keys).agg(F.min("day").alias("_a"), F.max("day").alias("_z"))
    a = F.col("_a") if lo is None else F.lit(lo)
    z = F.col("_z") if hi is None else F.lit(hi)
    cal = span.select(*keys, F.explode(F.sequence(a, z)).alias("day"))
    d = cal.join(n, [*keys, "day"], "left").withColumn("n_samples", F.coalesce("n_samples", F.lit(0)))
    return d.withColumn("present", F.col("n_samples") >= need)


def missing_days(coverage: DataFrame) -> DataFrame:
    return coverage.where(~F.col("present")).drop("present", "n_samples")


def fetch_plan(missing: DataFrame, base: str, code: str = "code", day: str = "day") -> DataFrame:
    """(code, day, url) of every day the archive lacks."""
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col(day).cast("int")), "yyyy-MM-dd")
    url = F.concat(F.lit(base + "?Request=GetData&observatoryIagaCode="), F.upper(F.col(code).cast("string")), F.lit("&dataStartDate="), date,
                   F.lit("&dataDuration=1&samplesPerDay=Second&publicationState=best-avail&format=iaga2002&orientation=XYZF"))
    return missing.withColumn("url", url)


def parse_day_lines(raw: DataFrame, key: str = "path") -> DataFrame:
    """Rows of landed IAGA-2002 text: header lines skipped, the data type as `pub`, fills and bad times removed."""
    v = F.col("value")
    head = v.rlike(r"^[ #|]") | v.startswith("DATE")
    pub = raw.where(v.rlike(r"^\s*Data Type\s+\S+")).groupBy(key).agg(F.lower(F.first(F.regexp_extract(v, r"Data Type\s+(\S+)", 1))).alias("pub"))
    f = F.split(F.trim(v), r"\s+")
    d = raw.where(~head & (v != "")).withColumn("_f", f)
    num = lambda k: (lambda x: F.when(F.abs(x) < FILL, x))(F.get("_f", k).try_cast("double"))
    ts = F.concat_ws(" ", F.get("_f", 0), F.get("_f", 1)).try_cast("timestamp")
    d = d.select(key, F.unix_micros(ts).alias("us"), num(3).alias("bx"), num(4).alias("by"), num(5).alias("bz"), num(6).alias("f")).where(F.col("us").isNotNull())
    return d.join(pub, key, "left").withColumn("pub", F.coalesce("pub", F.lit("unknown")))


def consolidate(year_rows: DataFrame, parts: DataFrame, keys: list[str], sec: str) -> DataFrame:
    """The union of a year's rows and its parts, one row per second, the year file's own row before a part's."""
    tag = lambda d, k: d.withColumn("_o", F.lit(k))
    u = tag(parts, 0).unionByName(tag(year_rows, 1), allowMissingColumns=True)
    rest = [c for c in u.columns if c not in (*keys, sec, "_o")]
    return u.groupBy(*keys, sec).agg(F.min_by(F.struct(*rest), "_o").alias("_r")).select(*keys, sec, "_r.*")


def write_if_complete(rows: DataFrame, calendar: DataFrame, sec: str, path: str) -> bool:
    """Rewrite a year file only where every expected day is there."""
    have = rows.select(((F.col(sec) - F.pmod(F.col(sec), F.lit(DAY))) / DAY).cast("bigint").alias("day")).distinct()
    if not calendar.select("day").join(have, "day", "left_anti").isEmpty():
        return False
    rows.repartitionByRange(sec).sortWithinPartitions(sec).write.mode("overwrite").parquet(path)
    return True
