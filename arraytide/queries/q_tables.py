"""Cell grammar and guarded table maintenance, on orders as the decisions table."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions import cells, names
from ..operators import readings, tables
from ..sources import survey
from .registry import query

# one text cell per order: undecided, assumed, blank or a value
OLD = """old AS (SELECT o_orderkey AS key, CASE o_orderkey % 5 WHEN 0 THEN 'decide' WHEN 1 THEN 'assume:' || o_orderstatus ELSE o_orderstatus END AS status,
  CASE o_custkey % 4 WHEN 0 THEN 'Decide' WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE o_orderpriority END AS prio,
  CASE o_orderkey % 6 WHEN 0 THEN 'note ' || o_custkey ELSE '' END AS notes FROM orders WHERE o_orderpriority <> '5-LOW')"""
NEW = """new AS (SELECT o_orderkey AS key, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'nan' ELSE o_orderstatus END AS status,
  CASE o_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'none' ELSE o_orderpriority END AS prio, 'new ' || o_custkey AS notes FROM orders WHERE o_orderstatus <> 'P')"""


def old(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.where(F.col("o_orderpriority") != "5-LOW").select(
        k.alias("key"), F.when(k % 5 == 0, "decide").when(k % 5 == 1, F.concat(F.lit("assume:"), "o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(c % 4 == 0, "Decide").when(c % 4 == 1, "none").when(c % 4 == 2, "").otherwise(F.col("o_orderpriority")).alias("prio"),
        F.when(k % 6 == 0, F.concat(F.lit("note "), c.cast("string"))).otherwise("").alias("notes"))


def new(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.where(F.col("o_orderstatus") != "P").select(
        k.alias("key"), F.when(k % 3 == 0, "").when(k % 3 == 1, "nan").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(c % 3 == 0, "").when(c % 3 == 1, "none").otherwise(F.col("o_orderpriority")).alias("prio"),
        F.concat(F.lit("new "), c.cast("string")).alias("notes"))


KEEP = "(lower(trim(o.{c})) = 'decide' OR lower(o.{c}) LIKE 'assume:%') AND lower(trim(n.{c})) IN ('', 'nan', '<na>')"


@query("guarded_upsert", "key:b status:s prio:s notes:s kept:b", "K2 D5",
       f"""WITH {OLD}, {NEW} SELECT n.key, CASE WHEN {KEEP.format(c='status')} THEN o.status ELSE n.status END AS status,
  CASE WHEN {KEEP.format(c='prio')} THEN o.prio ELSE n.prio END AS prio, n.notes,
  coalesce(CAST({KEEP.format(c='status')} AS INT), 0) + coalesce(CAST({KEEP.format(c='prio')} AS INT), 0) AS kept
  FROM new n LEFT JOIN old o ON o.key = n.key""")
def guarded_upsert(t):
    return tables.guarded_upsert(old(t), new(t), "key", ["status", "prio", "notes"])


@query("cell_diff", "key:b column:s old:s new:s", "K3 J12",
       f"""WITH {OLD}, {NEW} SELECT coalesce(o.key, n.key) AS key, '<row>' AS "column", CASE WHEN o.key IS NULL THEN '<absent>' ELSE 'present' END AS old,
  CASE WHEN o.key IS NULL THEN 'added' ELSE '<absent>' END AS new FROM old o FULL JOIN new n ON o.key = n.key WHERE o.key IS NULL OR n.key IS NULL
  UNION ALL SELECT o.key, 'status', o.status, n.status FROM old o JOIN new n ON o.key = n.key WHERE o.status <> n.status
  UNION ALL SELECT o.key, 'prio', o.prio, n.prio FROM old o JOIN new n ON o.key = n.key WHERE o.prio <> n.prio
  UNION ALL SELECT o.key, 'notes', o.notes, n.notes FROM old o JOIN new n ON o.key = n.key WHERE o.notes <> n.notes""")
def cell_diff(t):
    return tables.cell_diff(old(t), new(t), "key")


EMPTY = "lower(trim({x})) IN ('', 'nan', 'none', '<na>')"
TAKE = {c: f"(o.{c} IS NOT NULL AND NOT {EMPTY.format(x='o.' + c)} AND ({EMPTY.format(x='n.' + c)}{own}))"
        for c, own in (("status", ""), ("prio", ""), ("notes", " OR n.notes <> o.notes"))}


@query("carry_over", "key:b status:s prio:s notes:s n_kept:b", "K4",
       f"""WITH {OLD}, {NEW} SELECT n.key, CASE WHEN {TAKE['status']} THEN o.status ELSE n.status END AS status,
  CASE WHEN {TAKE['prio']} THEN o.prio ELSE n.prio END AS prio, CASE WHEN {TAKE['notes']} THEN o.notes ELSE n.notes END AS notes,
  CAST({TAKE['status']} AS INT) + CAST({TAKE['prio']} AS INT) + CAST({TAKE['notes']} AS INT) AS n_kept FROM new n LEFT JOIN old o ON o.key = n.key""")
def carry_over(t):
    d = tables.carry_over(new(t), old(t), "key", ["status", "prio", "notes"])
    return d.withColumn("n_kept", F.size("kept_columns"))


@query("carry_over_counts", "column:s n_kept:b", "K4",
       f"""WITH {OLD}, {NEW} SELECT 'status' AS "column", count(*) FILTER (WHERE {TAKE['status']}) AS n_kept FROM new n LEFT JOIN old o ON o.key = n.key
  UNION ALL SELECT 'prio', count(*) FILTER (WHERE {TAKE['prio']}) FROM new n LEFT JOIN old o ON o.key = n.key
  UNION ALL SELECT 'notes', count(*) FILTER (WHERE {TAKE['notes']}) FROM new n LEFT JOIN old o ON o.key = n.key""")
def carry_over_counts(t):
    return tables.kept_counts(tables.carry_over(new(t), old(t), "key", ["status", "prio", "notes"]))


@query("write_signs", "key:b sign_ex:s sign_hx:s sign_source:s written:b", "K5",
       """WITH st AS (SELECT c_custkey AS key, CASE c_custkey % 3 WHEN 0 THEN 'decide' WHEN 1 THEN '-1' ELSE 'DECIDE ' END AS sign_ex,
  CASE c_custkey % 2 WHEN 0 THEN 'decide' ELSE 'assume:1' END AS sign_hx, CASE c_custkey % 4 WHEN 0 THEN 'sheet' ELSE '' END AS sign_source FROM customer),
g AS (SELECT o_custkey AS key, sum(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN -1 ELSE 0 END) AS ex,
  sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) AS hx FROM orders GROUP BY 1),
j AS (SELECT st.*, CASE WHEN lower(trim(sign_ex)) = 'decide' AND ex <> 0 THEN CASE WHEN ex > 0 THEN '+1' ELSE '-1' END END AS wex,
  CASE WHEN lower(trim(sign_hx)) = 'decide' AND hx <> 0 THEN CASE WHEN hx > 0 THEN '+1' ELSE '-1' END END AS whx FROM st LEFT JOIN g ON g.key = st.key),
l AS (SELECT *, concat_ws('; ', 'sign_ex ' || wex || ' from quadrant', 'sign_hx ' || whx || ' from dc') || ', 2025-01-01' AS line FROM j)
SELECT key, coalesce(wex, sign_ex) AS sign_ex, coalesce(whx, sign_hx) AS sign_hx,
  CASE WHEN wex IS NULL AND whx IS NULL THEN sign_source WHEN sign_source = '' THEN line ELSE sign_source || ' | ' || line END AS sign_source,
  CAST(wex IS NOT NULL AS INT) + CAST(whx IS NOT NULL AS INT) AS written FROM l""")
def write_signs(t):
    k = F.col("c_custkey")
    st = t.customer.select(k.alias("key"), F.when(k % 3 == 0, "decide").when(k % 3 == 1, "-1").otherwise("DECIDE ").alias("sign_ex"),
                           F.when(k % 2 == 0, "decide").otherwise("assume:1").alias("sign_hx"),
                           F.when(k % 4 == 0, "sheet").otherwise("").alias("sign_source"))
    g = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", -1).otherwise(0)).alias("ex"),
        F.sum(F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)).alias("hx"))
    one = lambda c, v, why: F.struct(F.lit(c).alias("column"), F.when(F.col(v) != 0, F.signum(v).cast("int")).alias("value"), F.lit(why).alias("reason"))
    decided = g.select("key", F.explode(F.array(one("sign_ex", "ex", "quadrant"), one("sign_hx", "hx", "dc"))).alias("d")).select("key", "d.*")
    return tables.write_signs(st, decided, "key", ["sign_ex", "sign_hx"], "2025-01-01")


CHO = """och AS (SELECT o_custkey AS site, o_orderstatus AS component, 'tf' || max(o_orderkey) AS tf, CASE WHEN o_custkey % 3 = 0 THEN 'analyst' ELSE 'rule' END AS chosen_by
  FROM orders GROUP BY 1, 2), nch AS (SELECT o_custkey AS site, o_orderstatus AS component, 'tf' || min(o_orderkey) AS tf, 'rule' AS chosen_by
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2)"""


@query("priority_upsert", "site:b component:s tf:s chosen_by:s origin:s", "K9 T8",
       f"""WITH {CHO} SELECT *, 'locked' AS origin FROM och WHERE chosen_by = 'analyst'
  UNION ALL SELECT *, 'untouched' FROM och WHERE chosen_by <> 'analyst' AND NOT EXISTS (SELECT 1 FROM nch WHERE nch.site = och.site AND nch.component = och.component)
  UNION ALL SELECT *, 'written' FROM nch WHERE NOT EXISTS (SELECT 1 FROM och WHERE och.site = nch.site AND och.component = nch.component AND och.chosen_by = 'analyst')""")
def priority_upsert(t):
    k = [F.col("o_custkey").alias("site"), F.col("o_orderstatus").alias("component")]
    o = t.orders.groupBy(*k).agg(F.max("o_orderkey").alias("m")).select(
        "site", "component", F.concat(F.lit("tf"), "m").alias("tf"), F.when(F.col("site") % 3 == 0, "analyst").otherwise("rule").alias("chosen_by"))
    n = t.orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy(*k).agg(F.min("o_orderkey").alias("m")).select(
        "site", "component", F.concat(F.lit("tf"), "m").alias("tf"), F.lit("rule").alias("chosen_by"))
    return tables.priority_upsert(o, n, ["site", "component"])


@query("carry_other_sites", "site:b n:b extra:s", "K10 K6 K15",
       """WITH o AS (SELECT o_custkey AS site, count(*) AS n FROM orders GROUP BY 1), d AS (SELECT c_custkey AS site, 0 AS n, c_mktsegment AS extra FROM customer WHERE c_acctbal < 0)
SELECT site, n, NULL AS extra FROM o WHERE site NOT IN (SELECT site FROM d) UNION ALL SELECT * FROM d""")
def carry_other_sites(t):
    o = t.orders.groupBy(F.col("o_custkey").alias("site")).agg(F.count(F.lit(1)).alias("n"))
    d = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("site"), F.lit(0).cast("bigint").alias("n"), F.col("c_mktsegment").alias("extra"))
    return tables.carry_other_sites(o, d, "site", d)


LED = """led AS (SELECT o_custkey AS site, o_orderpriority AS run, o_orderstatus = 'F' AS made, o_orderkey AS seq, o_totalprice AS price FROM orders)"""


def led(t):
    return t.orders.select(F.col("o_custkey").alias("site"), F.col("o_orderpriority").alias("run"),
                           (F.col("o_orderstatus") == "F").alias("made"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price"))


@query("ledger_latest", "site:b run:s seq:b price:d made:z", "W11 D9",
       f"WITH {LED} SELECT site, run, seq, price, made FROM led QUALIFY row_number() OVER (PARTITION BY site, run ORDER BY made DESC, seq DESC) = 1")
def ledger_latest(t):
    return tables.latest(led(t), ["site", "run"], F.col("made"), ["seq"])


@query("choose_runs", "run:s stamp:s", "P16",
       "SELECT o_orderpriority AS run, max(strftime(o_orderdate, '%Y%m%d_%H%M')) AS stamp FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def choose_runs(t):
    d = t.orders.select(F.col("o_orderpriority").alias("run"), F.date_format("o_orderdate", "yyyyMMdd_HHmm").alias("stamp"))
    return tables.choose_runs(d, ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])


@query("cells_open", "key:b undecided:s assumed:s", "P11",
       f"""WITH {OLD} SELECT * FROM (SELECT key, concat_ws(', ', CASE WHEN lower(trim(notes)) = 'decide' THEN 'notes' END, CASE WHEN lower(trim(prio)) = 'decide' THEN 'prio' END,
  CASE WHEN lower(trim(status)) = 'decide' THEN 'status' END) AS undecided, concat_ws(', ', CASE WHEN lower(status) LIKE 'assume:%' THEN 'status=' || substr(status, 8) END) AS assumed FROM old)
  WHERE undecided <> '' OR assumed <> ''""")
def cells_open(t):
    return tables.open_cells(old(t), "key", ["status", "prio", "notes"])


@query("prefill_decisions", "key:b status:s prio:s", "K16",
       f"""WITH {OLD}, e AS (SELECT * FROM old WHERE lower(trim(prio)) IN ('none', '1-urgent'))
SELECT o.key, CASE WHEN e.key IS NOT NULL AND lower(trim(e.status)) NOT IN ('', 'nan', 'none', '<na>') THEN e.status ELSE 'decide' END AS status, 'decide' AS prio
FROM old o LEFT JOIN e ON e.key = o.key""")
def prefill_decisions(t):
    d = tables.blank_decisions(old(t), "key", ["status", "prio"])
    return tables.prefill(d, old(t), "key", ["status"], "prio", ("none", "1-urgent"))


@query("choose_sites", "site:b", "P12",
       """WITH m AS (SELECT c_mktsegment AS g, c_custkey AS site FROM customer), b AS (SELECT g FROM m GROUP BY g ORDER BY count(*) DESC, g LIMIT 1)
SELECT site FROM m WHERE g IN (SELECT g FROM b)""")
def choose_sites(t):
    m = t.customer.select(F.col("c_mktsegment").alias("group"), F.col("c_custkey").alias("site"))
    return tables.choose_sites(m.select("site"), "site", "site", "largest", m)


@query("cell_grammar", "key:b len:d len_state:s sign:d sign_ok:z yes:z yes_ok:z num:d num_ok:z name:s serial:s lender:s", "P6 D6 J18",
       """WITH c AS (SELECT o_orderkey AS key, CASE o_orderkey % 8 WHEN 0 THEN 'decide' WHEN 1 THEN 'assume:' || o_custkey WHEN 2 THEN '' WHEN 3 THEN 'none'
  WHEN 4 THEN ' -1 ' WHEN 5 THEN 'Yes' WHEN 6 THEN CAST(o_custkey AS VARCHAR) || '.0' ELSE o_orderpriority END AS cell,
  CASE o_custkey % 4 WHEN 0 THEN 'all' WHEN 1 THEN 'Hy, ex' WHEN 2 THEN 'hz hx' ELSE 'decide' END AS ch FROM orders),
d AS (SELECT *, lower(trim(cell)) AS lo, TRY_CAST(CASE WHEN lower(trim(cell)) LIKE 'assume:%' THEN substr(trim(cell), 8) ELSE trim(cell) END AS DOUBLE) AS v,
  TRY_CAST(trim(cell) AS DOUBLE) AS raw FROM c)
SELECT key, v AS len, CASE WHEN lo LIKE 'assume:%' THEN 'assume' WHEN v IS NULL THEN 'missing' ELSE 'value' END AS len_state,
  CASE WHEN raw IN (1, -1) THEN raw ELSE 1 END AS sign, coalesce(raw IN (1, -1), false) AS sign_ok, lo IN ('yes', 'y', 'true') AS yes,
  lo IN ('yes', 'y', 'true', 'no', 'n', 'false') AS yes_ok, coalesce(v, 2.5) AS num, v IS NOT NULL AS num_ok,
  CASE WHEN lo IN ('', 'nan', 'none', '<na>', 'decide') THEN '' ELSE trim(cell) END AS name,
  CASE WHEN lo IN ('', 'nan', 'none') THEN '' WHEN raw IS NULL THEN trim(cell) WHEN raw = floor(raw) THEN CAST(CAST(raw AS BIGINT) AS VARCHAR) ELSE trim(cell) END AS serial,
  CASE ch WHEN 'all' THEN 'hx hy hz' WHEN 'decide' THEN 'hx hy hz' WHEN 'Hy, ex' THEN 'hy' ELSE 'hx hz' END AS lender FROM d""")
def cell_grammar(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    cell = (F.when(k % 8 == 0, "decide").when(k % 8 == 1, F.concat(F.lit("assume:"), c.cast("string"))).when(k % 8 == 2, "").when(k % 8 == 3, "none")
            .when(k % 8 == 4, " -1 ").when(k % 8 == 5, "Yes").when(k % 8 == 6, F.concat(c.cast("string"), F.lit(".0"))).otherwise(F.col("o_orderpriority")))
    ch = F.when(c % 4 == 0, "all").when(c % 4 == 1, "Hy, ex").when(c % 4 == 2, "hz hx").otherwise("decide")
    d = t.orders.select(k.alias("key"), cell.alias("cell"), ch.alias("ch"))
    x = F.col("cell")
    d = d.select("key", cells.length(x).alias("l"), cells.sign(x).alias("s"), cells.yes_no(x).alias("y"), cells.number(x, 2.5).alias("n"),
                 cells.name(x).alias("name"), cells.tidy_serial(x).alias("serial"), F.array_join(cells.lender_channels(F.col("ch")), " ").alias("lender"))
    return d.select("key", F.col("l.value").alias("len"), F.col("l.state").alias("len_state"), F.col("s.value").alias("sign"), F.col("s.decided").alias("sign_ok"),
                    F.col("y.value").alias("yes"), F.col("y.decided").alias("yes_ok"), F.col("n.value").alias("num"), F.col("n.decided").alias("num_ok"), "name", "serial", "lender")


@query("windows_cell", "site:b windows:s", "K13 M7",
       """WITH w AS (SELECT o_custkey AS site, CASE WHEN o_orderstatus = 'F' THEN 'xy' ELSE 'yx' END AS component, min(o_orderkey) AS t_start, max(o_orderkey) + 1 AS t_end, count(*) AS days FROM orders GROUP BY 1, 2),
v AS (SELECT site, component, '"' || component || '":{"t_start":' || t_start || ',"t_end":' || t_end || ',"days":' || days || ',"reason":"orders"}' AS e FROM w WHERE days >= 4)
SELECT s.site, coalesce('{' || string_agg(e, ',' ORDER BY component) || '}', 'decide') AS windows FROM (SELECT DISTINCT site FROM w) s LEFT JOIN v ON v.site = s.site GROUP BY s.site""")
def windows_cell(t):
    w = t.orders.groupBy(F.col("o_custkey").alias("site"), F.when(F.col("o_orderstatus") == "F", "xy").otherwise("yx").alias("component")).agg(
        F.min("o_orderkey").alias("a"), (F.max("o_orderkey") + 1).alias("t_end"), F.count(F.lit(1)).alias("days"))
    w = w.select("site", "component", F.when(F.col("days") >= 4, F.col("a")).alias("t_start"), "t_end", "days", F.lit("orders").alias("reason"))
    return tables.windows_cell(w, "site")


@query("parse_names", "key:b site:s kind:s rate_hz:d selection:s params:s back:s key_name:s is_form:z run:s stamp:s", "P16 M6 P15",
       """WITH n AS (SELECT o_orderkey AS key, 'Q_' || o_custkey AS site, CASE o_orderkey % 4 WHEN 0 THEN 'stack_obs' WHEN 1 THEN 'stack' WHEN 2 THEN 'remote' ELSE 'obs' END AS kind,
  CASE o_orderkey % 2 WHEN 0 THEN 1 ELSE 10 END AS rate, CASE o_orderkey % 3 WHEN 0 THEN 'whole' WHEN 1 THEN 'stretch' ELSE 'control' END AS sel,
  CASE o_custkey % 3 WHEN 0 THEN 'recipe_x' WHEN 1 THEN 'window_zz' ELSE '' END AS form, 'repro_' || strftime(o_orderdate, '%Y%m%d_%H%M') AS folder FROM orders)
SELECT key, site, kind, rate AS rate_hz, sel AS selection, 'kaiser20_75' AS params, site || '_' || kind || '_' || rate || 'hz_' || CASE sel WHEN 'whole' THEN '' ELSE sel || '_' END || 'kaiser20_75' AS back,
  CASE WHEN form <> '' THEN form ELSE kind || '_' || rate || 'hz' || CASE sel WHEN 'whole' THEN '' ELSE '_' || sel END END AS key_name, form = 'recipe_x' AS is_form, 'repro' AS run, substr(folder, 7) AS stamp FROM n""")
def parse_names(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.when(k % 4 == 0, "stack_obs").when(k % 4 == 1, "stack").when(k % 4 == 2, "remote").otherwise("obs")
    d = t.orders.select(k.alias("key"), F.concat(F.lit("Q_"), c.cast("string")).alias("s"), kind.alias("kd"), F.when(k % 2 == 0, 1.0).otherwise(10.0).alias("r"),
                        F.when(k % 3 == 0, "whole").when(k % 3 == 1, "stretch").otherwise("control").alias("sel"),
                        F.when(c % 3 == 0, "recipe_x").when(c % 3 == 1, "window_zz").otherwise("").alias("form"),
                        F.concat(F.lit("repro_"), F.date_format("o_orderdate", "yyyyMMdd_HHmm")).alias("folder"))
    d = d.withColumn("back", names.response_name(F.col("s"), F.col("kd"), F.col("r"), F.col("sel"), F.lit("kaiser20_75")))
    run, stamp = names.run_and_stamp(F.col("folder"))
    return d.select("key", *[v.alias(n) for n, v in names.parse_response(F.col("back")).items()], "back",
                    names.response_key(F.col("kd"), F.col("r"), F.col("sel"), F.col("form")).alias("key_name"), names.is_form(F.col("form")).alias("is_form"), run.alias("run"), stamp.alias("stamp"))


@query("header_map", "doc_id:b n:b first:s", "M7 S20",
       """WITH l AS (SELECT doc_id, ord, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM documents)),
kv AS (SELECT doc_id, ord, trim(substr(line, 1, position('=' IN line) - 1)) AS k, trim(substr(line, position('=' IN line) + 1)) AS v FROM
  (SELECT doc_id, ord, 'lang=' || ord || '=' || line AS line FROM l UNION ALL SELECT doc_id, ord + 1000000, 'n' || (ord % 3) || ' = ' || ord FROM l)),
f AS (SELECT * FROM kv QUALIFY row_number() OVER (PARTITION BY doc_id, k ORDER BY ord) = 1)
SELECT doc_id, count(*) AS n, max(CASE WHEN k = 'n1' THEN v END) AS first FROM f GROUP BY doc_id""")
def header_map(t):
    lines = F.split("text", "\n")
    a = F.transform(lines, lambda x, i: F.concat(F.lit("lang="), (i + 1).cast("string"), F.lit("="), x))
    b = F.transform(lines, lambda x, i: F.concat(F.lit("n"), ((i + 1) % 3).cast("string"), F.lit(" = "), (i + 1).cast("string")))
    m = names.key_values(F.concat(a, b))
    return t.documents.select("doc_id", m.alias("m")).select("doc_id", F.size("m").alias("n"), F.col("m")["n1"].alias("first"))


@query("clean_lines", "doc_id:b line:s", "M6",
       r"""SELECT doc_id, trim(replace(replace(replace(text, '|', ' '), chr(10), ' '), chr(13), ' '), ' ') AS line FROM documents""")
def clean_lines(t):
    return t.documents.select("doc_id", names.clean_line(F.col("text")).alias("line"))


@query("pool_thresholds", "key:b own_ratio:d fleet_excess:d min_fleet:d", "P14 D7", """SELECT event_id AS key, 100.0 AS own_ratio, CASE WHEN event_id % 3 = 0 THEN CAST(json_extract(props, '$.k') AS DOUBLE) ELSE 10.0 END AS fleet_excess, 3.0 AS min_fleet FROM events""")
def pool_thresholds(t):
    cell = F.when(F.col("event_id") % 3 == 0, F.regexp_replace("props", '"k"', '"fleet_excess"')).otherwise("{}")
    return tables.thresholds(t.events.select(F.col("event_id").alias("key"), cell.alias("cell")), "key", "cell", {"own_ratio": 100, "fleet_excess": 10, "min_fleet": 3})


@query("read_choices", "site:b chosen_by:s note:s", "S21 S13", """SELECT c_custkey AS site, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'analyst' ELSE 'rule' END AS chosen_by, '' AS note FROM customer""")
def read_choices(t):
    d = t.customer.select(F.col("c_custkey").alias("site"), F.when(F.col("c_mktsegment") == "MACHINERY", " Analyst").otherwise(F.col("c_mktsegment")).alias("chosen_by"))
    return tables.read_choices(d, ["site", "chosen_by", "note"])


@query("widen_append", "site:b run:s seq:b price:d note:s", "K6", f"""WITH {LED} SELECT site, run, seq, price, NULL AS note FROM led WHERE made
  UNION ALL SELECT site, run, seq, NULL, 'stray ' || run FROM led WHERE NOT made""")
def widen_append(t):
    d = led(t)
    rows = d.where(~F.col("made")).select("site", "run", "seq", F.concat(F.lit("stray "), "run").alias("note"))
    return tables.widen_append(d.where("made").select("site", "run", "seq", "price"), rows)


@query("with_schema", "site:b run:s rmse:s", "K15", f"WITH {LED} SELECT site, run, NULL AS rmse FROM led WHERE made")
def with_schema(t):
    return tables.with_schema(led(t).where("made"), ["site", "run", "rmse"])


@query("to_build", "site:b run:s", "K1", f"""WITH {LED} SELECT DISTINCT site, run FROM led l WHERE NOT EXISTS (SELECT 1 FROM led m WHERE m.made AND m.site = l.site AND m.run = l.run)""")
def to_build(t):
    d = led(t)
    return survey.to_build(d.select("site", "run").distinct(), d.where("made"), ["site", "run"])


@query("unledgered", "path:s", "S18", f"""WITH {LED} SELECT DISTINCT site || '/' || run AS path FROM led WHERE site || '/' || run NOT IN (SELECT site || '/' || run FROM led WHERE made)""")
def unledgered(t):
    d = led(t).select(F.concat_ws("/", F.col("site").cast("string"), "run").alias("path"), "made")
    return survey.unledgered(d.select("path").distinct(), d.where("made"))


# customers as stations: orders are readings and, some of them, an analyst's rows
RD = """rd AS (SELECT o_custkey AS site, o_orderpriority AS tf, CASE WHEN o_orderkey % 7 = 0 THEN 'failed' ELSE 'ok' END AS status, o_totalprice AS bar, CASE WHEN o_orderkey % 5 = 0 THEN 'Analyst' ELSE 'rule' END AS chosen_by FROM orders),
tg AS (SELECT DISTINCT site, CASE site % 3 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '' END AS cell, '2-HIGH' AS the_rule FROM rd)"""


@query("choice_in_force", "site:b tf:s chosen_by:s bar:d matched:z departs:z", "T8", f"""WITH {RD}, a AS (SELECT site, max(tf) AS a FROM rd WHERE chosen_by = 'Analyst' GROUP BY site),
c AS (SELECT tg.site, coalesce(a, nullif(cell, ''), the_rule) AS tf, CASE WHEN a IS NOT NULL THEN 'analyst' WHEN cell <> '' THEN 'cell' ELSE 'rule' END AS chosen_by, the_rule FROM tg LEFT JOIN a ON a.site = tg.site),
r AS (SELECT site, tf, min(bar) AS bar FROM rd WHERE status = 'ok' GROUP BY ALL)
SELECT c.site, c.tf, chosen_by, bar, bar IS NOT NULL AS matched, c.tf <> the_rule AS departs FROM c LEFT JOIN r ON r.site = c.site AND r.tf = c.tf""")
def choice_in_force(t):
    k, s = F.col("o_orderkey"), F.col("o_custkey")
    rd = t.orders.select(s.alias("site"), F.col("o_orderpriority").alias("tf"), F.when(k % 7 == 0, "failed").otherwise("ok").alias("status"), F.col("o_totalprice").alias("bar"),
                         F.when(k % 5 == 0, "Analyst").otherwise("rule").alias("chosen_by"))
    tg = rd.select("site").distinct().withColumns({"cell": F.when(F.col("site") % 3 == 0, "1-URGENT").when(F.col("site") % 3 == 1, ""), "the_rule": F.lit("2-HIGH")})
    return readings.choice_in_force(tg, ["site"], rd, "cell", "the_rule", rd)
