"""Guarded maintenance of the survey tables. Every cell is text; nothing an analyst wrote is lost."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cells

ABSENT = "<absent>"


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def guarded_upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`new`, keeping a stored `decide` or `assume:` wherever the incoming cell is blank; `kept` counts them."""
    o = old.select(F.col(key), *[F.col(c).alias("_o_" + c) for c in columns if c in old.columns])
    d = as_text(new.select(key, *[F.col(c) if c in new.columns else F.lit("").alias(c) for c in columns])).join(o, key, "left")
    out, kept = [F.col(key)], F.lit(0)
    for c in columns:
        if c not in old.columns:
            out.append(F.col(c))
            continue
        stored = F.col("_o_" + c)
        keep = (cells.is_decide(stored) | cells.is_assumed(stored)) & cells.is_blank(F.col(c)) & (F.col(c) != stored)
        out.append(F.when(keep, stored).otherwise(F.col(c)).alias(c))
        kept = kept + F.coalesce(keep.cast("int"), F.lit(0))
    return d.select(*out, kept.alias("kept"))


def cell_diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, column, old, new) of every cell that differs, one row for a record only one side holds."""
    cols = sorted((set(old.columns) | set(new.columns)) - {key})
    pack = lambda df, p: df.select(F.col(key).alias(key), F.struct(*[
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit(ABSENT)).alias(c) for c in cols]).alias(p))
    j = pack(old, "_o").join(pack(new, "_n"), key, "full_outer")
    entry = lambda name, a, b: F.struct(F.lit(name).alias("column"), a.alias("old"), b.alias("new"))
    whole = F.when(F.col("_o").isNull(), F.array(entry("<row>", F.lit(ABSENT), F.lit("added")))) \
        .when(F.col("_n").isNull(), F.array(entry("<row>", F.lit("present"), F.lit(ABSENT))))
    differing = F.array_compact(F.array(*[
        F.when(F.col("_o")[c] != F.col("_n")[c], entry(c, F.col("_o")[c], F.col("_n")[c])) for c in cols]))
    return j.select(key, F.explode(F.coalesce(whole, differing)).alias("d")).select(key, "d.*")


def carry_over(new: DataFrame, old: DataFrame, key: str, columns: list[str], owned: tuple[str, ...] = ("notes",)) -> DataFrame:
    """Fill the empty cells of `new` from `old`; an owned column always keeps the old value where it holds one."""
    o = old.select(key, *[F.col(c).alias("_o_" + c) for c in columns])
    d = new.join(o, key, "left")
    out, kept = [F.col(c) for c in new.columns if c not in columns], []
    for c in columns:
        was = F.col("_o_" + c)
        now = F.col(c).cast("string") if c in new.columns else F.lit("")
        take = ~cells.is_empty(was) & (cells.is_empty(now) | (F.lit(c in owned) & (F.coalesce(now, F.lit("")) != was)))
        take = F.coalesce(take, F.lit(False))
        out.append(F.when(take, was).otherwise(now).alias(c))
        kept.append(F.when(take, F.lit(c)))
    return d.select(*out, F.array_compact(F.array(*kept)).alias("kept_columns"))


def kept_counts(carried: DataFrame) -> DataFrame:
    """How many cells of each column were carried over."""
    return (carried.select(F.explode("kept_columns").alias("column")).groupBy("column")
            .agg(F.count(F.lit(1)).alias("n_kept")))


def write_signs(stored: DataFrame, decided: DataFrame, key: str, sign_columns: list[str], dated: str,
                source: str = "sign_source") -> DataFrame:
    """Write measured signs into cells that read `decide` and into no others, with the clause that says why.

    `decided` is long: (key, column, value, reason); a NULL value was not judged and is not written.
    """
    d = decided.where(F.col("value").isNotNull()).groupBy(key).agg(
        F.map_from_entries(F.collect_set(F.struct("column", F.struct("value", "reason")))).alias("_m"))
    j = stored.join(d, key, "left")
    fmt = lambda v: F.format_string("%+d", v.cast("int"))
    out, clauses = [F.col(c) for c in stored.columns if c not in sign_columns and c != source], []
    for c in sorted(sign_columns):
        got = F.col("_m")[c]
        write = F.coalesce(cells.is_decide(F.col(c)) & got.isNotNull(), F.lit(False))
        out.append(F.when(write, fmt(got["value"])).otherwise(F.col(c)).alias(c))
        clauses.append(F.when(write, F.concat(F.lit(c + " "), fmt(got["value"]), F.lit(" from "), got["reason"])))
    line = F.array_compact(F.array(*clauses))
    full = F.concat(F.array_join(line, "; "), F.lit(", " + dated))
    was = F.col(source)
    text = F.when(F.size(line) == 0, was).when(cells.low(was).isin(*cells.NOTHING_WORDS), full) \
        .otherwise(F.concat(was, F.lit(" | "), full))
    return j.select(*out, text.alias(source), F.size(line).alias("written"))


def priority_upsert(old: DataFrame, fresh: DataFrame, keys: list[str], by: str = "chosen_by",
                    locked: str = "analyst") -> DataFrame:
    """Rows an analyst chose stay; other stored rows are replaced where a fresh one exists and kept where not."""
    lock = old.where(F.col(by) == locked)
    new = fresh.join(lock.select(*keys), keys, "left_anti")
    rest = old.where(F.col(by) != locked).join(new.select(*keys), keys, "left_anti")
    tag = lambda df, s: df.withColumn("origin", F.lit(s))
    return tag(lock, "locked").unionByName(tag(rest, "untouched")).unionByName(tag(new, "written"))


def carry_other_sites(old: DataFrame, table: DataFrame, key: str, delivered: DataFrame) -> DataFrame:
    """The table with the delivered stations' rows replaced and every other station's kept, columns united."""
    return old.join(delivered.select(key).distinct(), key, "left_anti").unionByName(table, allowMissingColumns=True)


def widen_append(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows to a ledger whose header may only widen."""
    return ledger.unionByName(rows, allowMissingColumns=True)


def with_schema(df: DataFrame, columns: list[str]) -> DataFrame:
    """A fixed column list; a column the frame lacks is NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def open_cells(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per record the undecided and the assumed cells, each as one sorted line; complete records are left out."""
    und = F.array_compact(F.array(*[F.when(cells.is_decide(F.col(c)), F.lit(c)) for c in sorted(columns)]))
    asm = F.array_compact(F.array(*[F.when(cells.is_assumed(F.col(c)), F.concat(
        F.lit(c + "="), cells.after_assume(F.col(c)))) for c in sorted(columns)]))
    return df.select(key, F.array_join(und, ", ").alias("undecided"), F.array_join(asm, ", ").alias("assumed")).where(
        (F.col("undecided") != "") | (F.col("assumed") != ""))


def blank_decisions(sites: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A decisions table with `decide` in every cell but the key."""
    return sites.select(key, *[F.lit(cells.DECIDE).alias(c) for c in columns])


def prefill(decisions: DataFrame, earlier: DataFrame, key: str, columns: list[str], how: str,
            accepted: tuple[str, ...]) -> DataFrame:
    """Copy an earlier decision into an open cell only where the word saying how it was made is accepted."""
    e = earlier.where(F.lower(F.trim(F.col(how))).isin(*accepted)).select(
        key, *[F.col(c).alias("_e_" + c) for c in columns])
    d = decisions.join(e, key, "left")
    out = [F.when(cells.is_decide(F.col(c)) & ~F.coalesce(cells.is_empty(F.col("_e_" + c)), F.lit(True)), F.col("_e_" + c))
           .otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in decisions.columns]
    return d.select(*out)


def latest(ledger: DataFrame, keys: list[str], made: Column, seq: list[str]) -> DataFrame:
    """The last row of each key, a row that made its file before one that only found it."""
    rest = [c for c in ledger.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(made.cast("int"), *seq))
    return ledger.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def choose_runs(ledger: DataFrame, runs: str | list[str] = "latest") -> DataFrame:
    """The (run, stamp) pairs a parameter names: every pair, or the latest stamp of every or of the named runs."""
    pairs = ledger.select("run", "stamp").distinct()
    if isinstance(runs, str) and runs == "all":
        return pairs
    if not isinstance(runs, str):
        pairs = pairs.where(F.col("run").isin(*runs))
    return pairs.groupBy("run").agg(F.max("stamp").alias("stamp"))


def choose_sites(sites: DataFrame, key: str, order: str, spec: str | list[str], members: DataFrame | None = None,
                 max_sites: int = 0) -> DataFrame:
    """All stations, a named list, one group or the largest one; a head limit in register order where asked for.

    `members` is (group, <key>).
    """
    d = sites
    if not isinstance(spec, str):
        d = sites.where(F.col(key).isin(*spec))
    elif spec != "all":
        g = members.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
        g = g.orderBy(F.desc("_n"), "group").limit(1) if spec == "largest" else g.where(F.col("group") == spec)
        d = sites.join(members.join(g.select("group"), "group", "left_semi").select(key), key, "left_semi")
    return d.orderBy(order).limit(max_sites) if max_sites else d


def windows_cell(windows: DataFrame, key: str) -> DataFrame:
    """The JSON cell of one station: component -> window, components without a window left out.

    A station has two components, so the map is bounded.
    """
    d = windows.where(F.col("t_start").isNotNull())
    entry = F.struct(F.col("component"), F.struct("t_start", "t_end", "days", "reason"))
    cell = d.groupBy(key).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_set(entry)))).alias("windows"))
    return windows.select(key).distinct().join(cell, key, "left").withColumn("windows", F.coalesce("windows", F.lit(cells.DECIDE)))


def numbered(df: DataFrame, keys: list[str], order: list, name: str = "n") -> DataFrame:
    """Row number inside a small ordered group such as a curve or a station's table."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def thresholds(configs: DataFrame, key: str, cell: str, defaults: dict[str, float]) -> DataFrame:
    """The thresholds of each survey block from its JSON cell, every missing one at its stated default."""
    m = F.from_json(F.col(cell), "map<string,double>")
    return configs.select(key, *[F.coalesce(F.try_element_at(m, F.lit(n)), F.lit(float(v))).alias(n) for n, v in defaults.items()])


def read_choices(table: DataFrame, columns: list[str], by: str = "chosen_by", known: tuple[str, ...] = ("rule", "analyst")) -> DataFrame:
    """A choice table with its fixed columns; whoever chose is read as the rule unless the cell says otherwise."""
    d = table.select(*[F.col(c) if c in table.columns else F.lit("").alias(c) for c in columns])
    return d.withColumn(by, F.when(cells.low(F.col(by)).isin(*known), cells.low(F.col(by))).otherwise(known[0]))
