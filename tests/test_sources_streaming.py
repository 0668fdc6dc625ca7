import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from arraytide.operators import axis, site, tables
from arraytide.sources import files, observatory, survey
from arraytide.streaming import landing, quality, regimes


def tree(root):
    for d, stamp, ext, body in (("001", "250101000000", "BX", "1\n2\n3\n"), ("001", "250101000000", "BY", "4\n5\n6\n"), ("001", "250101000003", "BX", "7\n8\n9\n"), ("001", "250101000002", "BX", "50\n")):
        p = os.path.join(root, "Q1", d)
        os.makedirs(p, exist_ok=True)
        name = f"Q1_{stamp}.{ext}" if body != "50\n" else f"Q1{stamp}.{ext}"
        open(os.path.join(p, name), "w").write(body)
    open(os.path.join(root, "Q1", "001", "LAB_250101000000.BX"), "w").write("0\n")
    open(os.path.join(root, "Q1", "001", "Q1_250101000000.gps"), "w").write(">RPV00000-3700000+14000000000000 06;")


def test_logger_folder_to_axis(spark, tmp_path):
    tree(str(tmp_path))
    row = files.discover(files.listing(spark, str(tmp_path))).first()
    assert (row.site, row.n_data_files, row.sidecars, row.dropped) == ("Q1", 4, "gps:1", "LAB_/test:1")
    s = files.samples_from_lines(files.lines(spark, str(tmp_path), "Q1*.B*"), 1.0)
    placed = axis.place(s.where("chan = 'hx'"), ["site"], "pos", ["value"], ["file"])
    got = [r.value for r in placed.orderBy("pos").collect()]
    assert len(got) == 6 and got[0] == 1.0 and got[5] == 9.0


def test_names_are_counted_and_read_once_and_foreign_stems_judged_by_the_own_span(spark):
    f = lambda stem, day, ext="BX": f"/raw/Q1/001/{stem}{day}000000.{ext}"
    paths = [f("Q1_", "250301"), f("Q1", "250401"), f("X_", "250131"), f("X_", "250129"), f("Y", "250501"), f("Y", "250502"), f("Q1_", "250301", "gps"), f("Q1_", "251399"),
             f("Q1_", "250301", "xyz"), "/raw/Q1/002/none.BX", "/raw/Q1/day/Q1_250301000000.BX", "/raw/Q2/001/Q2.gps", "/raw/Q3/001/Z_010203000000.EY"]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    rows = {r.site: r for r in files.discover(spark.createDataFrame([(p,) for p in paths], "path string").mapInPandas(counted, "path string"), 2020).collect()}
    # once for their number, once for what they say
    assert read.value == 2 * len(paths)
    q = rows["Q1"]
    assert (q.n_day_folders, q.n_data_files, q.first_stamp, q.last_stamp) == (2, 5, "250131000000", "251399000000")
    assert (q.stem_styles, q.sidecars, q.dropped) == ("Q1 Q1_ X_ Y", "gps:1", "ext .xyz:1; foreign stem:2; no stamp:1")
    assert (rows["Q2"].n_data_files, rows["Q2"].first_stamp, rows["Q2"].dropped) == (0, "", "no stamp:1")
    assert (rows["Q3"].n_data_files, rows["Q3"].first_stamp, rows["Q3"].date_correction) == (1, "010203000000", "+1024 weeks")


def test_expected_station_without_a_folder_keeps_a_row(spark, tmp_path):
    tree(str(tmp_path))
    want = spark.createDataFrame([("Q1",), ("Q2",)], "site string")
    rows = {r.site: r for r in files.discover(files.listing(spark, str(tmp_path)), expected=want).collect()}
    assert rows["Q2"].dropped == "folder absent" and rows["Q2"].n_data_files == 0


def test_text_table_keeps_empty_cells_and_an_absent_file_is_empty(spark, tmp_path):
    p = str(tmp_path / "t.csv")
    open(p, "w").write("site,sign_ex\nA,decide\nB,\n")
    d = survey.read_text_table(spark, p, ["site", "sign_ex"])
    assert {(r.site, r.sign_ex) for r in d.collect()} == {("A", "decide"), ("B", "")}
    assert survey.is_stub(survey.read_text_table(spark, str(tmp_path / "none.csv"), ["site"]))


def test_record_store_replaces_only_its_partitions(spark, tmp_path):
    root = str(tmp_path / "rec")
    mk = lambda s, v: spark.createDataFrame([(s, 1, i, float(v)) for i in range(5)], "site string, rate_hz int, i long, hx double")
    survey.write_record(mk("A", 1).unionByName(mk("B", 2)), root)
    survey.write_record(mk("B", 3), root)
    got = {r.site: r.hx for r in survey.read_record(spark, root, 1).select("site", "hx").distinct().collect()}
    assert got == {"A": 1.0, "B": 3.0}


def test_station_ids_stay_text_in_the_store(spark, tmp_path):
    root = str(tmp_path / "rec")
    rows = spark.createDataFrame([(s, 1, i, float(i)) for s in ("007", "7", "1e3") for i in range(3)], "site string, rate_hz int, i long, hx double")
    survey.write_record(rows, root)
    assert sorted(r.site for r in survey.read_record(spark, root, 1).select("site").distinct().collect()) == ["007", "1e3", "7"]
    assert survey.read_record(spark, root, 1, ["007"]).count() == 3


def test_year_file_is_rewritten_only_when_complete(spark, tmp_path):
    rows = spark.createDataFrame([(d * 86400,) for d in (0, 1, 3)], "sec long")
    cal = spark.range(4).withColumnRenamed("id", "day")
    assert not observatory.write_if_complete(rows, cal, "sec", str(tmp_path / "y"))
    assert observatory.write_if_complete(rows.unionByName(spark.createDataFrame([(2 * 86400,)], "sec long")), cal, "sec", str(tmp_path / "y"))


def test_manifest_catches_a_change(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for n in "ab":
        (tmp_path / "f" / n).write_text(n)
    scan = lambda: site.manifest(spark.read.format("binaryFile").load(str(tmp_path / "f")).select("path", "content"))
    recorded = spark.createDataFrame(scan().toPandas())
    (tmp_path / "f" / "b").write_text("changed")
    got = {os.path.basename(r.path): r.sha256_matches for r in site.manifest_check(recorded, scan()).collect()}
    assert got == {"a": True, "b": False}


def test_analyst_row_is_immutable(spark):
    s = "site string, component string, tf string, chosen_by string"
    old = spark.createDataFrame([("A", "xy", "mine", "analyst"), ("B", "xy", "old", "rule"), ("C", "xy", "keep", "rule")], s)
    new = spark.createDataFrame([("A", "xy", "new", "rule"), ("B", "xy", "new", "rule")], s)
    got = {r.site: (r.tf, r.origin) for r in tables.priority_upsert(old, new, ["site", "component"]).collect()}
    assert got == {"A": ("mine", "locked"), "B": ("new", "written"), "C": ("keep", "untouched")}


def source(spark, path, pdf, schema, per_file=1):
    os.makedirs(path, exist_ok=True)
    for k, part in enumerate(np.array_split(pdf, max(1, len(pdf) // per_file))):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_landing_keeps_the_later_file(spark, tmp_path):
    schema = "site string, i long, v double, f int"
    pdf = pd.DataFrame([("A", 1, 1.0, 1), ("A", 2, 2.0, 1), ("A", 2, 9.0, 2), ("A", 3700, 5.0, 2)], columns=["site", "i", "v", "f"])
    st = source(spark, str(tmp_path / "in"), pdf, schema, 2)
    landing.land(st, str(tmp_path / "out"), str(tmp_path / "ck"), ["site"], "i", ["v"], ["f"]).awaitTermination(120)
    got = {r.i: r.v for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: 1.0, 2: 9.0, 3700: 5.0}


def test_landing_later_file_wins_for_ids_that_look_like_numbers(spark, tmp_path):
    schema = "site string, i long, v double, f int"
    pdf = pd.DataFrame([("007", 1, 1.0, 1), ("7", 1, 5.0, 1), ("007", 1, 9.0, 2), ("007", 2, 3.0, 2)], columns=["site", "i", "v", "f"])
    st = source(spark, str(tmp_path / "in"), pdf, schema, 2)
    landing.land(st, str(tmp_path / "out"), str(tmp_path / "ck"), ["site"], "i", ["v"], ["f"]).awaitTermination(120)
    out = survey.with_text_partitions(spark, str(tmp_path / "out"), ["site"])
    assert {(r.site, r.i): r.v for r in out.collect()} == {("007", 1): 9.0, ("7", 1): 5.0, ("007", 2): 3.0}


def test_overlaps_are_counted_exactly(spark, tmp_path):
    t = pd.to_datetime("2024-01-01") + pd.to_timedelta([*range(0, 3000, 3), *range(0, 300, 3), 90000], unit="s")
    st = source(spark, str(tmp_path / "in"), pd.DataFrame({"ts": t, "site": "A"}), "ts timestamp, site string", 2000)
    got = run(landing.overlap_counter(st, "ts", ["site"]), "overlaps").collect()
    assert [(r.samples_read, r.positions, r.overlaps) for r in got] == [(1100, 1000, 100)]


def run(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name)


def test_tumbling_chunks_and_sessions(spark, tmp_path):
    t = pd.to_datetime("2024-01-01") + pd.to_timedelta(list(range(0, 1800, 60)) + list(range(7200, 7500, 60)) + [90000], unit="s")
    pdf = pd.DataFrame({"ts": t, "site": "A", "v": np.arange(len(t), dtype=float)})
    st = source(spark, str(tmp_path / "in"), pdf, "ts timestamp, site string, v double", 100)
    got = run(quality.tumbling(st, "ts", ["site"], "v", "10 minutes", "1 minute", whole=10), "tumbling").collect()
    assert len(got) == 3 and all(r.n == 10 for r in got)
    ses = run(quality.sessions(st, "ts", ["site"], "5 minutes", "1 minute"), "sessions").collect()
    assert sorted(r.n for r in ses) == [5, 30]


def test_stateful_clusters_match_the_batch_rule(spark, tmp_path):
    lat = [-30.0, -30.001, -30.02, -30.021, -30.0]
    pdf = pd.DataFrame({"folder": 1, "k": range(5), "lat": lat, "lon": 140.0})
    schema = "folder long, k long, lat double, lon double"
    batch = {r.k: r.cluster for r in files.position_clusters(spark.createDataFrame(pdf, schema), "folder", "k").collect()}
    st = source(spark, str(tmp_path / "in"), pdf, schema, 100)
    live = {r.k: r.cluster for r in run(regimes.clusters(st, "folder", "k"), "clusters").collect()}
    assert batch == live == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}


def test_clusters_stream_through_a_task_in_order(spark):
    rng = np.random.default_rng(4)
    rows = [(f, k, -30.0 + 0.004 * float(a), 140.0 + 0.004 * float(b)) for f in (1, 2, None) for k, (a, b) in enumerate(rng.integers(0, 4, (300, 2)))]
    want = {}
    for f in (1, 2, None):
        la, lo, n = [], [], 0
        for _, k, a, b in (r for r in rows if r[0] == f):
            if la:
                p1, p2 = np.radians(np.median(la)), np.radians(a)
                h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(b - np.median(lo)) / 2) ** 2
                if 2 * 6371.0088 * np.arcsin(np.sqrt(h)) > 1.0:
                    la, lo, n = [], [], n + 1
            la.append(a)
            lo.append(b)
            want[f, k] = n
    rng.shuffle(rows)
    schema = "folder long, k long, lat double, lon double"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.folder, r.k): r.cluster for r in files.position_clusters(spark.createDataFrame([tuple(r) for r in rows], schema), "folder", "k").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and max(want.values()) > 10


def test_a_fix_without_position_stays_with_its_deployment(spark):
    rows = [(1, 0, -30.0, 140.0), (1, 1, None, 140.0), (1, 2, float("nan"), 140.0), (1, 3, -30.0, 140.0), (1, 4, -31.0, 140.0)]
    d = files.position_clusters(spark.createDataFrame(rows, "folder long, k long, lat double, lon double"), "folder", "k")
    assert [r.cluster for r in d.orderBy("k").collect()] == [0, 0, 0, 0, 1]


def test_a_long_folder_costs_the_logarithm_of_its_fixes(spark):
    # 40,000 fixes of one folder: a median of all earlier fixes for each one takes minutes
    d = spark.range(40_000).selectExpr("1L as folder", "id as k", "-30.0D + (id % 7) * 0.0001D as lat", "140.0D as lon")
    assert files.position_clusters(d, "folder", "k").groupBy("cluster").count().first()["count"] == 40_000


def test_archive_read_prunes_rows_and_columns(spark, tmp_path):
    p = str(tmp_path / "y")
    t = pd.to_datetime("2024-01-01") + pd.to_timedelta(range(100), unit="s")
    pdf = pd.DataFrame({"DateTime": t, "BX": 1.0, "BY": 2.0, "BZ": np.where(np.arange(100) == 50, np.nan, 3.0), "F": 9.0, "pub": "d"})
    spark.createDataFrame(pdf, "DateTime timestamp, BX double, BY double, BZ double, F double, pub string").write.parquet(p)
    t0 = 1704067200
    d = observatory.load(spark, [p], t0 + 40, 20)
    rows = {r.i: r.mask for r in d.collect()}
    assert len(rows) == 20 and not rows[t0 + 50] and rows[t0 + 51]
    plan = d._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(DateTime)" in plan and "F:double" not in plan.replace("BF:double", "")
