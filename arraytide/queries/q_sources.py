"""Logger files and archives, on paths and lines Spark derives from the tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, names
from ..sources import files, observatory, survey
from ..streaming import landing, quality
from .bind import EV, ev, with_
from .q_register import km_sql
from .registry import query

# one hourly file per order: station = customer, stamp = order date, extension by order key, some of them junk
FL = """fl AS (SELECT o_orderkey AS k, 'C' || o_custkey AS site, strftime(orders.o_orderdate, '%y%m%d') || '000000' AS stamp, CASE o_orderkey % 11 WHEN 0 THEN 'gps' WHEN 1 THEN 'xyz' WHEN 2 THEN 'bat' ELSE list_extract(['BX','BY','BZ','EX','EY'], o_orderkey % 5 + 1) END AS ext,
  CASE WHEN o_orderkey % 13 = 0 THEN 'LAB_' WHEN o_orderkey % 17 = 0 THEN '._' ELSE '' END AS pre, o_orderkey % 19 = 0 AS foreign_, o_orderkey % 23 = 0 AS nostamp, o_orderdate + INTERVAL (CASE WHEN year(o_orderdate) < 2000 THEN 100 ELSE 0 END) YEAR AS o_orderdate, o_orderkey % 3 AS dayf FROM orders),
pt AS (SELECT *, pre || CASE WHEN foreign_ THEN 'X' ELSE site || '_' END || CASE WHEN nostamp THEN 'none' ELSE stamp END || '.' || ext AS name, lpad(CAST(dayf AS VARCHAR), 3, '0') AS folder FROM fl)"""


def pt(t):
    k = F.col("o_orderkey")
    ext = F.when(k % 11 == 0, "gps").when(k % 11 == 1, "xyz").when(k % 11 == 2, "bat").otherwise(F.element_at(F.array(*[F.lit(x) for x in ("BX", "BY", "BZ", "EX", "EY")]), (k % 5 + 1).cast("int")))
    site = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    pre = F.when(k % 13 == 0, "LAB_").when(k % 17 == 0, "._").otherwise("")
    stem = F.when(k % 19 == 0, "X").otherwise(F.concat(site, F.lit("_")))
    stamp = F.when(k % 23 == 0, "none").otherwise(F.concat(F.date_format("o_orderdate", "yyMMdd"), F.lit("000000")))
    folder = F.lpad((k % 3).cast("string"), 3, "0")
    path = F.concat_ws("/", F.lit("/raw"), site, folder, F.concat(pre, stem, stamp, F.lit("."), ext))
    return t.orders.select(k.alias("k"), path.alias("path"), F.col("o_totalprice").cast("bigint").alias("length"))


CLS = """cl AS (SELECT *, CASE WHEN pre = '._' THEN 'AppleDouble' WHEN pre = 'LAB_' THEN 'LAB_/test' WHEN ext = 'bat' THEN 'operator script' WHEN nostamp THEN 'no stamp' WHEN ext = 'xyz' THEN 'ext .xyz' ELSE '' END AS why FROM pt),
ow AS (SELECT site, min(o_orderdate) AS a, max(o_orderdate) AS z FROM cl WHERE why = '' AND ext <> 'gps' AND NOT foreign_ GROUP BY site),
cf AS (SELECT cl.* REPLACE (CASE WHEN why = '' AND ext <> 'gps' AND foreign_ AND (o_orderdate < a - INTERVAL 30 DAY OR o_orderdate > z + INTERVAL 30 DAY) THEN 'foreign stem' ELSE why END AS why) FROM cl LEFT JOIN ow ON ow.site = cl.site)"""


@query("discover_files", "site:s n_day_folders:b n_data_files:b first_stamp:s last_stamp:s stem_styles:s sidecars:s dropped:s date_correction:s", "S1 P1 P2 P3 P4", with_(FL, CLS, """g AS (SELECT site, count(DISTINCT folder) AS n_day_folders, count(*) FILTER (WHERE why = '' AND ext <> 'gps') AS n_data_files,
  coalesce(min(stamp) FILTER (WHERE why = '' AND ext <> 'gps'), '') AS first_stamp, coalesce(max(stamp) FILTER (WHERE why = '' AND ext <> 'gps'), '') AS last_stamp, count(*) FILTER (WHERE why = '' AND ext = 'gps') AS ng FROM cf GROUP BY site),
s AS (SELECT site, string_agg(st, ' ' ORDER BY st) AS stems FROM (SELECT DISTINCT site, CASE WHEN foreign_ THEN 'X' ELSE site || '_' END AS st FROM cf WHERE why = '' AND ext <> 'gps') GROUP BY site), d AS (SELECT site, string_agg(w, '; ' ORDER BY w) AS dr FROM (SELECT site, why || ':' || count(*) AS w FROM cf WHERE why <> '' GROUP BY site, why) GROUP BY site)""")
       + """SELECT g.site, n_day_folders, n_data_files, first_stamp, last_stamp, coalesce(stems, '') AS stem_styles, CASE WHEN ng > 0 THEN 'gps:' || ng ELSE '' END AS sidecars, coalesce(dr, '') AS dropped,
  CASE WHEN first_stamp <> '' AND CASE WHEN CAST(substr(first_stamp, 1, 2) AS INT) < 100 THEN 2000 + CAST(substr(first_stamp, 1, 2) AS INT) END < 2001 THEN '+1024 weeks' ELSE '' END AS date_correction FROM g LEFT JOIN s USING (site) LEFT JOIN d USING (site)""")
def discover_files(t):
    return files.discover(pt(t), 2001)


@query("discover_daily_files", "site:s n_folders:b n_daily_files:b n_inf:b first_stamp:s last_stamp:s n_dropped:b", "S2", """WITH f AS (SELECT 'C' || o_custkey AS site, o_orderkey % 2 AS d, o_orderkey % 9 AS m, strftime(o_orderdate, '%Y%m%d0000') AS st FROM orders)
SELECT site, count(DISTINCT d) AS n_folders, count(*) FILTER (WHERE m > 2) AS n_daily_files, count(*) FILTER (WHERE m = 0) AS n_inf, min(st) FILTER (WHERE m > 2) AS first_stamp, max(st) FILTER (WHERE m > 2) AS last_stamp, count(*) FILTER (WHERE m IN (1, 2)) AS n_dropped FROM f GROUP BY site""")
def discover_daily_files(t):
    k = F.col("o_orderkey")
    m = k % 9
    name = F.concat(F.date_format("o_orderdate", "yyyyMMdd'0000'"), F.when(m == 0, ".INF").when(m == 1, ".dat").otherwise(".TXT"))
    name = F.when(m == 2, F.lit("readme.TXT")).otherwise(name)
    p = t.orders.select(F.concat_ws("/", F.lit("/raw"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.concat(F.lit("DATA000"), (k % 2).cast("string")), name).alias("path"))
    return files.discover_daily(p)


@query("stem_audit", "site:s stem:s side:s", "U3 J17", with_(FL) + """SELECT DISTINCT site, st AS stem, 'first' AS side FROM (SELECT site, pre || CASE WHEN foreign_ THEN 'X' ELSE site || '_' END AS st, ext, pre, nostamp FROM pt WHERE NOT nostamp) q WHERE NOT EXISTS (SELECT 1 FROM pt p WHERE p.site = q.site AND pre = '' AND ext IN ('BX','BY','BZ','EX','EY') AND NOT nostamp AND CASE WHEN foreign_ THEN 'X' ELSE p.site || '_' END = q.st)""")
def stem_audit(t):
    c = files.classify(pt(t)).where(F.col("stamp") != "")
    return files.stem_audit(c, c.where(F.col("kind") == "data"))


@query("rollover_stamps", "key:b ts:b label:s", "P3", """SELECT o_orderkey AS key, epoch_us(CASE WHEN year(o_orderdate) < 1998 THEN o_orderdate + INTERVAL 8 YEAR ELSE o_orderdate END) // 1000000 AS ts, '' AS label FROM orders WHERE false
UNION ALL SELECT o_orderkey, epoch_us(d) // 1000000 + CASE WHEN year(d) < 2004 THEN 7168 * 86400 ELSE 0 END, CASE WHEN year(d) < 2004 THEN '+1024 weeks' ELSE '' END FROM (SELECT o_orderkey, o_orderdate + INTERVAL (CASE WHEN year(o_orderdate) < 2000 THEN 2922 ELSE 0 END) DAY AS d FROM orders)""")
def rollover_stamps(t):
    d = t.orders.select(F.col("o_orderkey").alias("key"), F.date_add(F.to_date("o_orderdate"), F.when(F.year("o_orderdate") < 2000, 2922).otherwise(0)).alias("d"))
    ts, label = names.corrected(names.stamp_time(F.concat(F.date_format("d", "yyMMdd"), F.lit("000000"))), 2004)
    return d.select("key", F.unix_seconds(ts).alias("ts"), label.alias("label"))


@query("sample_lines", "site:s chan:s pos:b value:d", "S3 S9 D1", with_(EV) + """SELECT 'S' || site AS site, CASE k % 2 WHEN 0 THEN 'hx' ELSE 'ey' END AS chan, (sec // 3600) * 3600 * 10 + k AS pos, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS value FROM ev""")
def sample_lines(t):
    e = ev(t)
    hour = F.timestamp_seconds(F.floor(F.col("sec") / 3600) * 3600)
    site = F.concat(F.lit("S"), F.col("site").cast("string"))
    name = F.concat(site, F.date_format(hour, "yyMMddHHmmss"), F.when(F.col("k") % 2 == 0, ".BX").otherwise(".EY"))
    raw = e.select(F.concat_ws("/", F.lit("/raw"), site, F.lit("001"), name).alias("path"), F.col("k").alias("line_no"),
                   F.when(F.col("event_id") % 50 == 0, "junk").otherwise(F.concat(F.lit(" "), F.col("value").cast("string"))).alias("value"))
    return files.samples_from_lines(raw, 10.0)


@query("daily_rows", "path:s ts:b hx:d ey:d lat:d lon:d n_sat:b", "S4 M6", with_(EV) + """SELECT 'd' || site AS path, sec AS ts, value AS hx, k AS ey, -(23 + (k + 0.5) / 60.0) AS lat, 140 + (k + 0.25) / 60.0 AS lon, k % 12 AS n_sat FROM ev WHERE event_id % 40 <> 0""")
def daily_rows(t):
    e = ev(t)
    ts = F.timestamp_seconds("sec")
    z = F.lit("0")
    k = F.col("k")
    fields = [F.date_format(ts, p) for p in ("yyyy", "MM", "dd", "HH", "mm", "ss")] + [F.col("value").cast("string")] + [z] * 5 + [k.cast("string")] + [z] * 4 + [
        (2300 + k + 0.5).cast("string"), F.lit("S"), (14000 + k + 0.25).cast("string"), F.lit("E"), (k % 12).cast("string")]
    line = F.when(F.col("event_id") % 40 == 0, "short row").otherwise(F.concat_ws("  ", *fields))
    return files.lemi_rows(e.select(F.concat(F.lit("d"), F.col("site").cast("string")).alias("path"), line.alias("value")))


@query("gps_fixes", "site:b lat:d lon:d elev_m:d n_sat:b", "S5", """SELECT c_custkey AS site, -(2000000 + c_custkey % 7000000) / 1e5 AS lat, (14000000 + c_custkey) / 1e5 AS lon, CAST(c_custkey % 900 AS DOUBLE) AS elev_m, c_custkey % 13 AS n_sat FROM customer WHERE c_custkey % 10 <> 0""")
def gps_fixes(t):
    k = F.col("c_custkey")
    lat = F.when(k % 10 == 0, -9500000).otherwise(-(2000000 + k % 7000000))
    s = F.concat(F.lit(">RST00;"), F.lit(">RAL00000"), F.format_string("%+06d", k % 900), F.lit("+00000;"), F.lit(">RPV00000"), F.format_string("%+08d", lat), F.format_string("%+09d", 14000000 + k), F.lit("000000"), F.format_string("%02d", k % 13), F.lit(";>RPV000"))
    return files.gps_fixes(t.customer.select(k.alias("site"), s.alias("content")))


@query("gps_position", "nation:b n_fixes:b n_below_floor:b lat:d lon:d elev_m:d scatter_m:d", "A1", """WITH f AS (SELECT c_nationkey AS nation, -30 - (c_custkey % 97) * 1e-5 AS lat, 140 + (c_custkey % 89) * 1e-5 AS lon, CAST(c_custkey % 70 AS DOUBLE) AS el, c_custkey % 13 AS ns FROM customer), g AS (SELECT * FROM f WHERE ns >= 3),
m AS (SELECT nation, median(lat) AS la, median(lon) AS lo, median(el) AS el FROM g GROUP BY nation), s AS (SELECT g.nation, quantile_cont(sqrt(pow((lat - la) * 111320.0, 2) + pow((lon - lo) * 111320.0 * cos(radians(la)), 2)), 0.95) AS sc FROM g JOIN m ON m.nation = g.nation GROUP BY g.nation)
SELECT f.nation, count(*) FILTER (WHERE ns >= 3) AS n_fixes, count(*) FILTER (WHERE ns < 3) AS n_below_floor, max(la) AS lat, max(lo) AS lon, max(m.el) AS elev_m, max(sc) AS scatter_m FROM f LEFT JOIN m ON m.nation = f.nation LEFT JOIN s ON s.nation = f.nation GROUP BY f.nation""")
def gps_position(t):
    k = F.col("c_custkey")
    f = t.customer.select(F.col("c_nationkey").alias("nation"), (-30 - (k % 97) * 1e-5).alias("lat"), (140 + (k % 89) * 1e-5).alias("lon"), (k % 70).cast("double").alias("elev_m"), (k % 13).alias("n_sat"))
    return files.position(f, ["nation"])


@query("inf_in_force", "site:b inf_key:s serial:s firmware:s L1:d inf_lat:d inf_missing:z", "S6", """WITH b AS (SELECT o_custkey AS site, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS inf_key, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'P' || o_custkey END AS nm, o_orderkey FROM orders WHERE o_orderstatus <> 'F'),
j AS (SELECT c_custkey AS site, b.*, substr(inf_key, 1, 8) <= '1999' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '15' AS early FROM customer LEFT JOIN b ON b.site = c_custkey)
SELECT site, inf_key, CASE WHEN o_orderkey IS NOT NULL THEN 'N' || o_orderkey END AS serial, CASE WHEN o_orderkey IS NOT NULL THEN '1.' || o_orderkey % 5 END AS firmware, o_orderkey / 4.0 AS L1, CASE WHEN o_orderkey IS NOT NULL THEN -(37 + (o_orderkey % 59) / 60.0) END AS inf_lat, o_orderkey IS NULL AS inf_missing FROM
(SELECT * EXCLUDE (site_1) FROM j) QUALIFY row_number() OVER (PARTITION BY site ORDER BY nm <> '' DESC, early DESC, CASE WHEN early THEN -CAST(inf_key AS BIGINT) ELSE CAST(inf_key AS BIGINT) END) = 1""")
def inf_in_force(t):
    k = F.col("o_orderkey")
    s = lambda c: c.cast("string")
    key = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(s(k % 10000), 4, "0"))
    text = F.concat(F.lit("%LEMI424 #N"), s(k), F.lit("\n%FIRMWARE Ver.1."), s(k % 5), F.lit("\n%L1 = "), s(k / 4.0), F.lit("\n%Lat "), s(3700 + k % 59), F.lit(".0,S\n"),
                    F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("%Site P"), s(F.col("o_custkey")), F.lit("\n"))))
    b = files.parse_inf(t.orders.where(F.col("o_orderstatus") != "F").select(F.col("o_custkey").alias("site"), F.concat(F.lit("/x/"), key, F.lit(".INF")).alias("path"), text.alias("content")))
    st = t.customer.select(F.col("c_custkey").alias("site"), F.concat(F.lit("1999"), F.lpad(s(F.col("c_custkey") % 12 + 1), 2, "0"), F.lit("15")).alias("first_key"))
    return files.inf_in_force(b, st)


ST2 = """f AS (SELECT site, (sec // 3600) * 3600 AS t, 10 * 3600 + (max(k) % 3) * 9000 AS n FROM ev GROUP BY site, sec // 3600)"""


def hour_files(t):
    return ev(t).groupBy("site", (F.floor(F.col("sec") / 3600) * 3600).alias("t")).agg((36000 + (F.max("k") % 3) * 9000).alias("n"))


@query("sample_rate", "site:b rate_hz:d n_pairs:b", "S8", with_(EV, ST2, """r AS (SELECT site, CAST(n AS DOUBLE) / (lead(t) OVER (PARTITION BY site, t // 86400 ORDER BY t) - t) AS r FROM f), s AS (SELECT site, (SELECT a FROM (SELECT unnest([1.0, 2.0, 2.5, 5.0, 10.0, 12.5]) AS a) WHERE abs(r.r / a - 1) <= 0.02 ORDER BY abs(r.r / a - 1) LIMIT 1) AS s FROM r WHERE r IS NOT NULL),
c AS (SELECT site, s, count(*) AS n FROM s WHERE s IS NOT NULL GROUP BY ALL)""") + "SELECT site, arg_max(s, (n, s)) AS rate_hz, sum(n) AS n_pairs FROM c GROUP BY site")
def sample_rate(t):
    return files.sample_rate(hour_files(t), ["site"], [1.0, 2.0, 2.5, 5.0, 10.0, 12.5])


@query("file_spans", "site:b t_start:b t_end:d", "S7", with_(EV, ST2) + "SELECT site, min(t) AS t_start, max(t) + (arg_max(n, t) - 1) / 10.0 AS t_end FROM f GROUP BY site")
def file_spans(t):
    return files.file_spans(hour_files(t).withColumn("rate_hz", F.lit(10.0)), ["site"])


@query("first_and_last_rows", "lang:s first:s last:s n:b", "S9", """WITH w AS (SELECT doc_id, lang, string_split_regex(trim(text, ' '), '\\s+') AS f FROM documents) SELECT lang, arg_min(f[1], doc_id) AS "first", arg_max(f[1], doc_id) AS "last", count(*) AS n FROM w WHERE len(f) >= 21 GROUP BY lang""")
def first_and_last_rows(t):
    d = t.documents.select("doc_id", "lang", F.split(F.trim("text"), r"\s+").alias("fields"))
    r = files.first_and_last(d, ["lang"], "doc_id")
    return r.select("lang", F.get("first_row", F.lit(0)).alias("first"), F.get("last_row", F.lit(0)).alias("last"), "n")


@query("station_scan", "site:b serial:s serial_source:s dipole_n_m:s dipole_source:s release_separation_km:d days:d", "S10 S15", f"""WITH o AS (SELECT o_custkey AS site, epoch_us(min(o_orderdate)) // 1000000 AS a, epoch_us(max(o_orderdate)) // 1000000 AS z FROM orders GROUP BY 1),
d AS (SELECT c_custkey AS site, o.a, o.z, -25.0 AS lat, 140 + c_custkey % 10 AS lon, -25.0 - c_custkey % 3 * 0.01 AS lat2, 140.0 + c_custkey % 10 AS lon2, c_custkey % 4 AS m, c_custkey % 5 AS r FROM customer LEFT JOIN o ON o.site = c_custkey),
u AS (SELECT site, lat, lon FROM d), v AS (SELECT site, lat2 AS lat, lon2 AS lon FROM d)
SELECT d.site, CASE WHEN m = 0 THEN 'own' || d.site WHEN r = 0 THEN 'rel' || d.site ELSE '' END AS serial, CASE WHEN m = 0 THEN 'own file' WHEN r = 0 THEN 'release' ELSE '' END AS serial_source, CASE WHEN m = 0 THEN '48' WHEN m = 1 THEN 'assume:50' WHEN r = 0 THEN '52' ELSE '' END AS dipole_n_m,
  CASE WHEN m = 0 THEN 'own file' WHEN m = 1 THEN 'default' WHEN r = 0 THEN 'release' ELSE '' END AS dipole_source, CASE WHEN r = 0 THEN {km_sql('u', 'v')} END AS release_separation_km, round((z - a) / 86400.0, 3) AS days FROM d JOIN u ON u.site = d.site JOIN v ON v.site = d.site""")
def station_scan(t):
    k = F.col("c_custkey")
    s = lambda c: c.cast("string")
    c = t.customer.select(k.alias("site"))
    x = F.col("site")
    spans = t.orders.groupBy(F.col("o_custkey").alias("site")).agg(F.unix_seconds(F.min("o_orderdate").cast("timestamp")).alias("t_start"), F.unix_seconds(F.max("o_orderdate").cast("timestamp")).alias("t_end"))
    own = c.where(x % 4 == 0).select("site", F.concat(F.lit("own"), s(x)).alias("own_serial"), F.lit("48").alias("own_dipole"))
    dft = c.where(x % 4 == 1).select("site", F.lit("assume:50").alias("default_dipole"))
    rel = c.where(x % 5 == 0).select("site", F.concat(F.lit("rel"), s(x)).alias("release_serial"), F.lit("52").alias("release_dipole"), (-25.0 - x % 3 * 0.01).alias("release_lat"), (140.0 + x % 10).alias("release_lon"))
    return files.scan(c.withColumns({"lat": F.lit(-25.0), "lon": 140.0 + x % 10}), spans, own, dft, rel)


@query("arm_lengths", "site:b dipole_n_m:s dipole_e_m:s dipole_source:s", "S15", """SELECT c_custkey AS site, CASE WHEN c_custkey % 3 = 0 THEN '47.5' ELSE 'assume:50' END AS dipole_n_m, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN '49' ELSE 'assume:50' END AS dipole_e_m, CASE WHEN c_custkey % 3 = 0 THEN 'sheet' ELSE 'nominal' END AS dipole_source FROM customer""")
def arm_lengths(t):
    k = F.col("c_custkey")
    sheet = t.customer.where(k % 3 == 0).select(k.alias("site"), F.lit("47.5").alias("dipole_n_m"), F.when(k % 2 == 0, "49").otherwise("").alias("dipole_e_m"), F.lit("sheet").alias("source"))
    return survey.arm_lengths(t.customer.select(k.alias("site")), sheet, 50.0, "nominal")


@query("reference_table", "site:b lat:d", "S14", "SELECT s_suppkey AS site, s_acctbal AS lat FROM supplier WHERE s_nationkey = 7")
def reference_table(t):
    return survey.read_reference(t.supplier, {"site": "s_suppkey", "lat": "s_acctbal", "elev": "no_such_column"}, {"s_nationkey": "7", "phase": "x"})


@query("find_responses", "site:s path:s on_disk:z", "S18 P16 J17", """WITH l AS (SELECT 'Q' || o_custkey AS site, CASE o_orderkey % 2 WHEN 0 THEN 'stack' ELSE 'obs' END AS kind, 'run_' || strftime(o_orderdate, '%Y%m%d_%H%M') AS f, o_orderkey FROM orders)
SELECT site, path, bool_and(o_orderkey % 3 <> 0) OVER (PARTITION BY path) AS on_disk FROM (SELECT *, site || '/' || f || '/' || site || '_' || kind || '_1hz_kaiser20_75.edi' AS path FROM l)""")
def find_responses(t):
    k = F.col("o_orderkey")
    led = t.orders.select(k, F.concat(F.lit("Q"), F.col("o_custkey").cast("string")).alias("site"), F.when(k % 2 == 0, "stack").otherwise("obs").alias("kind"), F.lit(1.0).alias("rate_hz"), F.lit("").alias("selection"), F.lit("kaiser20_75").alias("params"),
                          F.lit("run").alias("run"), F.date_format("o_orderdate", "yyyyMMdd_HHmm").alias("stamp"))
    # files found on disk: those of two orders in three, one row per path
    f = survey.find_responses(led, led.limit(0).select(F.lit("").alias("path"))).groupBy("path").agg(F.max(F.when(F.col("o_orderkey") % 3 != 0, 1)).alias("h"), F.count_if(F.col("o_orderkey") % 3 == 0).alias("z")).where(F.col("h").isNotNull() & (F.col("z") == 0))
    return survey.find_responses(led, f.select("path"))


@query("calendar_gaps", "etype:s day:b url:s", "A6 K8 J17", with_(EV, """n AS (SELECT etype, sec // 86400 AS day, count(*) AS n FROM ev WHERE event_id % 3 = 0 OR etype < 'p' GROUP BY ALL), c AS (SELECT etype, unnest(generate_series(min(day), max(day))) AS day FROM n GROUP BY etype)""") + """SELECT c.etype, c.day,
  'x?Request=GetData&observatoryIagaCode=' || upper(c.etype) || '&dataStartDate=' || strftime(DATE '1970-01-01' + CAST(c.day AS INT), '%Y-%m-%d') || '&dataDuration=1&samplesPerDay=Second&publicationState=best-avail&format=iaga2002&orientation=XYZF' AS url
  FROM c LEFT JOIN n ON n.etype = c.etype AND n.day = c.day WHERE coalesce(n, 0) < 60""")
def calendar_gaps(t):
    e = ev(t).where((F.col("event_id") % 3 == 0) | (F.col("etype") < "p"))
    cov = observatory.day_coverage(e, ["etype"], "sec", need=60)
    return observatory.fetch_plan(observatory.missing_days(cov), "x", "etype")


@query("parse_archive_day", "path:s us:b bx:d by:d pub:s", "S12", with_(EV) + """SELECT 'p' || site AS path, sec * 1000000 AS us, CASE WHEN k % 9 = 0 THEN NULL ELSE value END AS bx, CAST(k AS DOUBLE) AS "by", CASE site % 2 WHEN 0 THEN 'definitive' ELSE 'unknown' END AS pub FROM ev""")
def parse_archive_day(t):
    e = ev(t)
    path = F.concat(F.lit("p"), F.col("site").cast("string"))
    line = F.concat_ws("  ", F.date_format(F.timestamp_seconds("sec"), "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("001"), F.when(F.col("k") % 9 == 0, "99999.00").otherwise(F.col("value").cast("string")), F.col("k").cast("string"), F.lit("-88888.5"), F.lit("1"))
    head = e.select(path.alias("path")).distinct().select("path", F.explode(F.when(F.regexp_extract("path", r"(\d+)", 1).cast("int") % 2 == 0, F.array(F.lit(" Data Type              Definitive          |"), F.lit("DATE       TIME"))).otherwise(F.array(F.lit("# a comment")))).alias("value"))
    return observatory.parse_day_lines(e.select(path.alias("path"), line.alias("value")).unionByName(head))


@query("consolidate_archive", "site:b sec:b v:d", "K7 U1", with_(EV) + """SELECT site, sec, arg_min(v, o) AS v FROM (SELECT site, sec, max(value) AS v, 1 AS o FROM ev WHERE k < 60 GROUP BY ALL UNION ALL SELECT site, sec, max(value) + 1000, 0 FROM ev WHERE k > 40 GROUP BY ALL) GROUP BY ALL""")
def consolidate_archive(t):
    e = ev(t)
    y = e.where(F.col("k") < 60).groupBy("site", "sec").agg(F.max("value").alias("v"))
    p = e.where(F.col("k") > 40).groupBy("site", "sec").agg((F.max("value") + 1000).alias("v"))
    return observatory.consolidate(y, p, ["site"], "sec")


@query("position_clusters", "folder:b cluster:b n:b", "W16 R4")
def position_clusters(t):
    o = t.orders.select(F.col("o_custkey").alias("folder"), F.col("o_orderkey").alias("key"), (-30.0 - (F.col("o_totalprice").cast("bigint") % 4) * 0.004).alias("lat"), F.lit(140.0).alias("lon"))
    return files.position_clusters(o, "folder", "key").groupBy("folder", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query("union_responses", "site:b run:s n:b src:s", "U1 S18", """WITH a AS (SELECT o_custkey AS site, o_orderpriority AS run, count(*) AS n, 'ledger' AS src, 0 AS o FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2 UNION ALL SELECT o_custkey, o_orderpriority, count(*), 'forms', 1 FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2 UNION ALL
  SELECT o_custkey, o_orderpriority, count(*), 'stray', 2 FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2) SELECT site, run, n, src FROM a QUALIFY row_number() OVER (PARTITION BY site, run ORDER BY o) = 1""")
def union_responses(t):
    def part(s, tag):
        return t.orders.where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("site"), F.col("o_orderpriority").alias("run")).agg(F.count(F.lit(1)).alias("n")).withColumn("src", F.lit(tag))
    return survey.all_responses(part("F", "ledger"), part("O", "forms"), part("P", "stray"), ["site", "run"])


@query("day_files", "path:s n:b first_ts:b last_ts:b refused:z short:z", "S4", with_(EV) + """SELECT 'd' || site AS path, count(*) AS n, min(sec) AS first_ts, max(sec) AS last_ts,
  coalesce(abs((count(*) - 1.0) / nullif(max(sec) - min(sec), 0) - 1) > 1e-6, false) AS refused, count(*) <> 86400 AS short FROM (SELECT DISTINCT site, sec FROM ev) GROUP BY site""")
def day_files(t):
    return files.day_file_report(ev(t).select(F.concat(F.lit("d"), F.col("site").cast("string")).alias("path"), F.col("sec").alias("ts")).distinct())


@query("default_length", "instrument:s metres:d", "S15", "SELECT p_brand AS instrument, CASE WHEN p_brand LIKE '%1' THEN 50.0 ELSE max(p_size) END AS metres FROM part GROUP BY p_brand")
def default_length(t):
    own = t.part.groupBy(F.col("p_brand").alias("instrument")).agg(F.max("p_size").cast("double").alias("value"))
    return survey.default_length(own, F.when(F.col("instrument").endswith("1"), F.lit(50.0)))


@query("overlap_counter", "site:b hour:b samples_read:b positions:b overlaps:b", "R1", with_(EV) + """SELECT site, sec // 3600 AS hour, sum(n) AS samples_read, count(*) AS positions, sum(n) - count(*) AS overlaps
  FROM (SELECT site, sec, count(*) AS n FROM ev GROUP BY ALL) GROUP BY ALL""")
def overlap_counter(t):
    d = ev(t).select("site", F.timestamp_seconds("sec").alias("ts"))
    return landing.overlap_counter(d, "ts", ["site"]).select("site", F.floor(F.unix_timestamp("window.start") / 3600).alias("hour"), "samples_read", "positions", "overlaps")


@query("sliding_correlation", "site:b t0:b r2:d n:b", "R3", with_(EV) + """SELECT site, w * 1800 AS t0, pow(covar_pop(value, k), 2) / nullif(var_pop(value) * var_pop(k), 0) AS r2, count(*) AS n
  FROM (SELECT site, value, k, unnest([sec // 1800, sec // 1800 - 1]) AS w FROM ev) GROUP BY ALL""")
def sliding_correlation(t):
    d = ev(t).select("site", F.timestamp_seconds("sec").alias("ts"), "value", "k")
    g = quality.sliding_correlation(d, "ts", ["site"], "value", "k")
    return g.select("site", F.unix_timestamp("t_start").alias("t0"), "r2", "n")
