"""Logger files: name scans, sample lines, positions and power-up blocks.

Every parser takes a DataFrame of paths or lines, so the same plan reads a folder through `spark.read` or any
other table of them. A name scan never opens a file: the content column is pruned from the listing.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import geo, names
from ..functions.kernels import RunningMedian
from ..operators.quantiles import group_percentiles
from ..session import cut_lineage

# fixed values
DATA_EXT = ("BX", "BY", "BZ", "EX", "EY")
SIDECAR_EXT = ("gps", "gst", "pll", "TP", "ambientTemperature", "batteryVolts2", "diskTemperature")
CHANNEL_OF = {"BX": "hx", "BY": "hy", "BZ": "hz", "EX": "ex", "EY": "ey"}
FOREIGN_DAYS = 30
FILES_A_TASK = 500_000
ROWS_PER_DAY = 86_400
MIN_SATELLITES = 3
SPLIT_KM = 1.0
LEMI_FIELDS = {"hx": 6, "hy": 7, "hz": 8, "ex": 11, "ey": 12}


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of every file under a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")


def lines(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, line_no, value) with exact line numbers. Files are hourly or daily, so one file is one bounded row."""
    d = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    d = d.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value"))
    return d.where(F.col("value") != "")


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _site(path: Column, depth: int) -> Column:
    return F.element_at(F.split(path, "/"), -depth)


def classify(files: DataFrame) -> DataFrame:
    """Each file of <site>/<day>/<name> with its stem, stamp, extension and why it is not a data file."""
    n = _name(F.col("path"))
    d = files.withColumns({"site": _site(F.col("path"), 3), "folder": _site(F.col("path"), 2), "name": n, "stem": names.stem(n), "stamp": names.stamp(n), "ext": names.extension(n)})
    why = names.drop_reason(F.col("name"))
    ext = F.col("ext")
    kind = (F.when(why != "", "dropped").when(F.col("stamp") == "", "dropped").when(F.upper(ext).isin(*DATA_EXT), "data")
            .when(ext.isin(*SIDECAR_EXT) | (F.upper(ext) == "TP"), "sidecar").otherwise("dropped"))
    reason = F.when(why != "", why).when(F.col("stamp") == "", "no stamp").otherwise(F.concat(F.lit("ext ."), ext))
    return d.withColumn("kind", kind).withColumn("reason", F.when(F.col("kind") == "dropped", reason).otherwise("")).where(F.col("folder").rlike("^[0-9]+$"))


def _said(files: DataFrame, n: int) -> DataFrame:
    """(site, folder, kind, label, at, n, a, z, t, u): what the files of a folder say about stems, extensions and reasons, counted in one pass.

    Data files of another stem are kept apart by their stamp `at`; `t` and `u` are the first and the last time. Stamps are compared as
    numbers, so that counting is hashed and no file is sorted. Names are dealt to `n` tasks by folder before they are counted.
    """
    c = F.col
    d = classify(files)
    own = F.upper(F.rtrim(F.regexp_replace("stem", "_+$", ""))) == F.upper("site")
    kind = F.when((c("kind") == "data") & ~own, "other").otherwise(c("kind"))
    d = d.select("site", "folder", kind.alias("kind"), F.when(c("kind") == "data", c("stem")).when(c("kind") == "sidecar", c("ext")).otherwise(c("reason")).alias("label"),
                 F.when(c("kind") == "data", c("stamp")).cast("bigint").alias("stamp")).repartition(n, "site", "folder")
    sec = F.unix_seconds(names.stamp_time(F.lpad(c("stamp").cast("string"), 12, "0")))
    d = d.withColumns({"sec": sec, "at": F.when(c("kind") == "other", c("stamp"))})
    return d.groupBy("site", "folder", "kind", "label", "at").agg(F.count(F.lit(1)).alias("n"), F.min("stamp").alias("a"), F.max("stamp").alias("z"), F.min("sec").alias("t"), F.max("sec").alias("u"))


def _foreign_judged(said: DataFrame, days: int, n: int) -> DataFrame:
    """(site, folder, kind, label, n, a, z): data files of another stem more than `days` outside the station's own span become dropped ones."""
    c = F.col
    span = said.where(c("kind") == "data").repartition(n, "site").groupBy("site").agg(F.min("t").alias("_t"), F.max("u").alias("_u"))
    out = F.coalesce((c("t") < c("_t") - days * 86400) | (c("t") > c("_u") + days * 86400), F.lit(False))
    d = said.where(c("kind") == "other").repartition(n, "site").join(span, "site", "left").withColumn("_out", out)
    d = d.select("site", "folder", F.when(c("_out"), "dropped").otherwise("data").alias("kind"), F.when(c("_out"), "foreign stem").otherwise(c("label")).alias("label"), "n",
                 *[F.when(~c("_out"), c(k)).alias(k) for k in ("a", "z")])
    return said.where(c("kind") != "other").select(*d.columns).unionByName(d)


def discover(files: DataFrame, first_year: int | None = None, expected: DataFrame | None = None) -> DataFrame:
    """One row per station from names alone: counts, first and last stamp, stems, sidecars, drops, date correction.

    Names are read once; what they say is counted by extension and reason before it is written into a line. The number of tasks follows
    the number of files, so that the counts one task holds do not grow with the listing. A station named in `expected` with no folder
    keeps a row that says so.
    """
    c = F.col
    n = files.count() // FILES_A_TASK + 1
    d = _foreign_judged(cut_lineage(_said(files, n)), FOREIGN_DAYS, n)
    folder = F.struct(F.lit("folder").alias("kind"), c("folder").alias("label"), F.lit(1).cast("bigint").alias("n"), *[F.lit(None).cast("bigint").alias(k) for k in ("a", "z")])
    d = d.repartition(n, "site").select("site", F.explode(F.array(F.struct("kind", "label", "n", "a", "z"), folder)).alias("s")).select("site", "s.*")
    d = d.groupBy("site", "kind", "label").agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("z").alias("z"))

    def line(kind: str, sep: str, what: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(c("kind") == kind, what))), sep)
    counted = F.concat("label", F.lit(":"), c("n").cast("string"))
    g = d.groupBy("site").agg(F.count_if(c("kind") == "folder").alias("n_day_folders"), F.sum(F.when(c("kind") == "data", c("n")).otherwise(0)).alias("n_data_files"), F.min("a").alias("a"), F.max("z").alias("z"),
                              line("data", " ", c("label")).alias("stem_styles"), line("sidecar", " ", counted).alias("sidecars"), line("dropped", "; ", counted).alias("dropped"))
    g = g.withColumns({out: F.lpad(c(k).cast("string"), 12, "0") for k, out in (("a", "first_stamp"), ("z", "last_stamp"))}).drop("a", "z")
    if expected is not None:
        g = expected.select("site").join(g, "site", "left")
        g = g.withColumn("dropped", F.when(F.col("n_day_folders").isNull(), "folder absent").otherwise(F.col("dropped")))
    ts, label = names.corrected(names.stamp_time(F.col("first_stamp")), first_year)
    fill = {c: F.coalesce(c, F.lit("")) for c in ("first_stamp", "last_stamp", "stem_styles", "sidecars", "dropped")}
    return g.withColumn("date_correction", F.coalesce(label, F.lit(""))).withColumns({**fill, "n_day_folders": F.coalesce("n_day_folders", F.lit(0)), "n_data_files": F.coalesce("n_data_files", F.lit(0))})


def discover_daily(files: DataFrame) -> DataFrame:
    """One row per station of <site>/DATA<nnnn>/<12 digits>.TXT: daily files, power-up blocks, everything else dropped."""
    n = _name(F.col("path"))
    d = files.withColumns({"site": _site(F.col("path"), 3), "folder": _site(F.col("path"), 2), "name": n}).where(F.upper("folder").startswith("DATA"))
    why, ext = names.drop_reason(F.col("name")), F.upper(names.extension(F.col("name")))
    st = F.regexp_extract("name", r"^(\d{12})", 1)
    day, inf = (why == "") & (ext == "TXT") & (st != ""), (why == "") & (ext == "INF")
    return d.withColumns({"_day": day, "_inf": inf, "_st": st}).groupBy("site").agg(
        F.countDistinct("folder").alias("n_folders"), F.count_if("_day").alias("n_daily_files"), F.count_if("_inf").alias("n_inf"),
        F.min(F.when(F.col("_day"), F.col("_st"))).alias("first_stamp"), F.max(F.when(F.col("_day"), F.col("_st"))).alias("last_stamp"), F.count_if(~F.col("_day") & ~F.col("_inf")).alias("n_dropped"))


def stem_audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stems only one of two independent walks found."""
    a, b = first.select("site", "stem").distinct(), second.select("site", "stem").distinct()
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))


def samples_from_lines(raw: DataFrame, fs: float, first_year: int | None = None) -> DataFrame:
    """(site, chan, file, pos, value) of one-value-per-line files: the name's stamp is the first line's time.

    `raw` is (path, line_no, value). `pos` counts samples from the epoch, so files of one station meet on one axis.
    """
    n = _name(F.col("path"))
    ts, _ = names.corrected(names.stamp_time(names.stamp(n)), first_year)
    v = F.trim("value").try_cast("double")
    chan = F.create_map(*[F.lit(x) for kv in CHANNEL_OF.items() for x in kv])[F.upper(names.extension(n))]
    pos = F.round(F.unix_seconds(ts) * F.lit(float(fs)), 0).cast("bigint") + F.col("line_no")
    return raw.select(_site(F.col("path"), 3).alias("site"), chan.alias("chan"), n.alias("file"), pos.alias("pos"), F.when(~F.isnan(v), v).alias("value"))


def lemi_rows(raw: DataFrame) -> DataFrame:
    """(path, ts, hx..ey, lat, lon, elev, n_sat) of whitespace rows; rows under 21 fields are left out."""
    f = F.split(F.trim("value"), r"\s+")
    d = raw.select("path", *[c for c in raw.columns if c not in ("path", "value")], f.alias("f")).where(F.size("f") >= 21)
    num = lambda k: F.get("f", k).try_cast("double")
    i = lambda k: num(k).cast("int")
    ts = F.unix_seconds(F.try_make_timestamp(i(0), i(1), i(2), i(3), i(4), F.floor(num(5)).cast("double")))
    return d.select(*[c for c in d.columns if c != "f"], ts.alias("ts"), *[num(k).alias(c) for c, k in LEMI_FIELDS.items()], names.ddmm(F.get("f", 17), F.get("f", 18)).alias("lat"),
                    names.ddmm(F.get("f", 19), F.get("f", 20)).alias("lon"), num(16).alias("elev_m"), num(21).cast("int").alias("n_sat"))


def day_file_report(rows: DataFrame) -> DataFrame:
    """Per daily file: rows, first and last time, whether it runs at 1 Hz and whether the day is short."""
    g = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    rate = F.try_divide(F.col("n") - 1, F.col("last_ts") - F.col("first_ts"))
    return g.withColumn("refused", F.coalesce(F.abs(rate - 1) > 1e-6, F.lit(False))).withColumn("short", F.col("n") != ROWS_PER_DAY)


def gps_fixes(texts: DataFrame) -> DataFrame:
    """Position fixes of fixed-width sentences: altitude paired by order, impossible fixes dropped."""
    rpv, ral = r">RPV(\d{5})([+-]\d{7})([+-]\d{8})(\d{6})(\d{2});", r">RAL(\d{5})([+-]\d{5})([+-]\d{5});"
    d = texts.withColumn("_alt", F.regexp_extract_all("content", F.lit(ral), F.lit(2)))
    d = d.withColumn("_p", F.arrays_zip(*[F.regexp_extract_all("content", F.lit(rpv), F.lit(k)).alias(n) for k, n in ((2, "la"), (3, "lo"), (5, "ns"))]))
    keep = [c for c in texts.columns if c != "content"]
    d = d.select(*keep, "_alt", F.posexplode("_p").alias("k", "p"))
    d = d.select(*keep, (F.col("p.la").cast("double") / 1e5).alias("lat"), (F.col("p.lo").cast("double") / 1e5).alias("lon"),
                 F.get("_alt", F.col("k")).cast("double").alias("elev_m"), F.col("p.ns").cast("int").alias("n_sat"))
    return d.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))


def position(fixes: DataFrame, keys: list[str], min_sat: int = MIN_SATELLITES) -> DataFrame:
    """Median position over the fixes with enough satellites, its 95th percentile scatter and the fixes left out."""
    good = fixes.where(F.col("n_sat") >= min_sat)
    med = group_percentiles(good, keys, "lat", {"lat": 0.5}).join(group_percentiles(good, keys, "lon", {"lon": 0.5}), keys)
    med = med.join(group_percentiles(good, keys, "elev_m", {"elev_m": 0.5}), keys, "left")
    off = good.select(*keys, F.col("lat").alias("_la"), F.col("lon").alias("_lo")).join(med, keys)
    m = F.sqrt(F.pow((F.col("_la") - F.col("lat")) * 111320.0, 2) + F.pow((F.col("_lo") - F.col("lon")) * 111320.0 * F.cos(F.radians("lat")), 2))
    sc = group_percentiles(off.withColumn("_m", m), keys, "_m", {"scatter_m": 0.95})
    n = fixes.groupBy(*keys).agg(F.count_if(F.col("n_sat") >= min_sat).alias("n_fixes"), F.count_if(F.col("n_sat") < min_sat).alias("n_below_floor"))
    return n.join(med, keys, "left").join(sc, keys, "left")


def parse_inf(texts: DataFrame) -> DataFrame:
    """One row per power-up block: key, station, serial, firmware, line lengths, position."""
    c = F.col("content")
    one = lambda p: F.regexp_extract(c, p, 1)
    num = lambda p: one(p).try_cast("double")
    la, lo = r"%Lat\s+([\d.]+)\s*,\s*([NS])", r"%Lon\s+([\d.]+)\s*,\s*([EW])"
    keep = [x for x in texts.columns if x != "content"]
    return texts.select(*keep, F.regexp_extract(_name(F.col("path")), r"^(\d{12})", 1).alias("inf_key"), one(r"%Site\s+(\S+)").alias("inf_site"), one(r"%LEMI424\s*#(\S+)").alias("serial"),
                        F.regexp_replace(one(r"%FIRMWARE\s+(\S+)"), r"(?i)^Ver\.?", "").alias("firmware"), *[num(rf"%L{k}\s*=\s*(\S+)").alias(f"L{k}") for k in (1, 2, 3, 4)],
                        names.ddmm(one(la), F.regexp_extract(c, la, 2)).alias("inf_lat"), names.ddmm(one(lo), F.regexp_extract(c, lo, 2)).alias("inf_lon"), num(r"%Alt\s+([-\d.]+)").alias("inf_alt"))


def inf_in_force(blocks: DataFrame, stations: DataFrame, key: str = "site") -> DataFrame:
    """The last block stamped on or before the day of the first data file; blocks naming a station preferred.

    Where none is early enough the first block stands, and a station without any keeps a flagged row.
    """
    rest = [c for c in blocks.columns if c != key]
    d = stations.select(key, "first_key").join(blocks, key)
    early = (F.col("inf_key") != "") & (F.substring("inf_key", 1, 8) <= F.substring("first_key", 1, 8))
    named = (F.col("inf_site") != "").cast("int")
    # named first, then early ones by their key falling, then the rest by their key rising
    best = F.min_by(F.struct(*rest), F.struct(-named, (~early).cast("int"), F.when(early, -F.col("inf_key").cast("bigint")).otherwise(F.col("inf_key").try_cast("bigint"))))
    g = d.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")
    return stations.select(key).join(g, key, "left").withColumn("inf_missing", F.col("inf_key").isNull())


def sample_rate(starts: DataFrame, keys: list[str], allowed: list[float], tolerance: float = 0.02) -> DataFrame:
    """The rate files were written at: samples over the time to the next file, snapped to an allowed rate, modal.

    `starts` is (keys, t, n), one row per file. The next file comes from a window over a station's files of one
    day, so no window spans a record.
    """
    w = Window.partitionBy(*keys, F.floor(F.col("t") / 86400)).orderBy("t")
    raw = F.try_divide(F.col("n").cast("double"), F.lead("t").over(w) - F.col("t"))
    d = starts.withColumn("_r", raw).where(F.col("_r").isNotNull())
    snap = F.array_min(F.transform(F.filter(F.array(*[F.lit(float(a)) for a in allowed]), lambda a: F.abs(F.col("_r") / a - 1) <= tolerance),
                                   lambda a: F.struct(F.abs(F.col("_r") / a - 1).alias("d"), a.alias("a"))))["a"]
    c = d.withColumn("_s", snap).where(F.col("_s").isNotNull()).groupBy(*keys, "_s").agg(F.count(F.lit(1)).alias("_n"))
    return c.groupBy(*keys).agg(F.max_by("_s", F.struct("_n", "_s")).alias("rate_hz"), F.sum("_n").alias("n_pairs"))


def file_spans(starts: DataFrame, keys: list[str]) -> DataFrame:
    """Record span from its first and last file: the end is the last file's start plus (n - 1) samples."""
    g = starts.groupBy(*keys).agg(F.min("t").alias("t_start"), F.max_by(F.struct("t", "n", "rate_hz"), "t").alias("_l"))
    return g.select(*keys, "t_start", (F.col("_l.t") + F.try_divide(F.col("_l.n") - 1, F.col("_l.rate_hz"))).alias("t_end"))


def first_and_last(rows: DataFrame, keys: list[str], order: str, min_fields: int = 21) -> DataFrame:
    """First and last complete row of each file."""
    ok = F.size("fields") >= min_fields
    return rows.where(ok).groupBy(*keys).agg(F.min_by("fields", order).alias("first_row"), F.max_by("fields", order).alias("last_row"), F.count(F.lit(1)).alias("n"))


def scan(discovery: DataFrame, spans: DataFrame, own: DataFrame, defaults: DataFrame, release: DataFrame, key: str = "site") -> DataFrame:
    """The station table: each value from its first source that has one, with the name of that source beside it.

    The release supplies a serial or an arm length only where the station's own files and the default do not;
    its position is for comparison, as a separation.
    """
    d = discovery.join(spans, key, "left").join(own, key, "left").join(defaults, key, "left").join(release, key, "left")
    pick = lambda *cs: F.coalesce(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(c).cast("string")) for c in cs], F.lit(""))
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    return d.withColumns({
        "serial": pick("own_serial", "release_serial"), "serial_source": F.when(has("own_serial"), "own file").when(has("release_serial"), "release").otherwise(""),
        "dipole_n_m": pick("own_dipole", "default_dipole", "release_dipole"),
        "dipole_source": F.when(has("own_dipole"), "own file").when(has("default_dipole"), "default").when(has("release_dipole"), "release").otherwise(""),
        "release_separation_km": geo.distance_km(F.col("lat"), F.col("lon"), F.col("release_lat"), F.col("release_lon")),
        "days": F.round((F.col("t_end") - F.col("t_start")) / 86400.0, 3)})


def position_clusters(fixes: DataFrame, folder: str, order: str, split_km: float = SPLIT_KM) -> DataFrame:
    """Deployments of one folder: a new one where a daily fix lies over `split_km` from the running median position.

    The rule depends on every earlier fix, so a folder is read in order by one task. Folders are dealt and sorted by Spark and stream through
    a task one after the other: what is held is the running deployment, in heaps either side of its medians, so a fix costs the logarithm of
    the fixes before it. A fix without a position stays with the deployment it came in and moves no median.
    """
    import pyarrow as pa

    d = fixes.select(folder, order, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))

    def cluster(batches):
        now, n, lat, lon = None, 0, RunningMedian(), RunningMedian()
        for batch in batches:
            out = []
            for key, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if now != (key,):
                    now, n, lat, lon = (key,), 0, RunningMedian(), RunningMedian()
                if a is not None and b is not None and a == a and b == b:
                    if lat and geo.km_between(lat.value(), lon.value(), a, b) > split_km:
                        n, lat, lon = n + 1, RunningMedian(), RunningMedian()
                    lat.add(a)
                    lon.add(b)
                out.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "cluster"])
    types = {f.name: f.dataType.simpleString() for f in d.schema}
    ordered = d.repartition(folder).sortWithinPartitions(F.col(folder), F.col(order).asc_nulls_last())
    return ordered.mapInArrow(cluster, f"`{folder}` {types[folder]}, `{order}` {types[order]}, lat double, lon double, cluster long")
