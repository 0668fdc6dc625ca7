"""The response tests, the readings table and the response of record."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import scalars
from . import curves

# fixed thresholds
QUADRANT_MIN = 0.70
SLOPE_LIMIT = 1.25
SLOPE_MIN = 0.80
BAR_MAX = 1.0
MIN_PERIODS = 8
HELD_BAR_MAX = 0.20


def response_tests(tf: DataFrame, keys: list[str], lo: float = 10.0, hi: float = 1000.0, quadrant_min: float = QUADRANT_MIN,
                   slope_limit: float = SLOPE_LIMIT, slope_min: float = SLOPE_MIN, bar_max: float = BAR_MAX,
                   min_periods: int = MIN_PERIODS, held_bar: float = HELD_BAR_MAX) -> DataFrame:
    """Phase, slope and error test of every curve, what it holds, and which tests it fails. One window, one aggregate."""
    s = scalars.with_scalars(tf)
    band = (F.col("period") >= lo) & (F.col("period") <= hi)
    read = band & (F.col("rho") > 0)
    # the slope is between neighbouring usable periods, so unusable ones sort into a window of their own
    w = Window.partitionBy(*keys, "_read").orderBy("period")
    s = s.withColumn("_read", F.coalesce(read, F.lit(False))).withColumns({
        "_dx": F.log10("period") - F.log10(F.lag("period").over(w)), "_dy": F.log10("rho") - F.log10(F.lag("rho").over(w))})
    slope = F.when(F.col("_read") & (F.col("_dx") > 0), (F.abs(F.col("_dy") / F.col("_dx")) <= slope_limit).cast("double"))
    ph, rel = F.col("phase"), F.col("rel")
    held = (rel < held_bar) & (ph >= 0) & (ph <= 90)
    g = s.groupBy(*keys).agg(
        F.avg(F.when(band & ph.isNotNull(), ((ph > 0) & (ph < 90)).cast("double"))).alias("phase_frac"),
        F.median(F.when(band, ph)).alias("median_phase_deg"), F.avg(slope).alias("slope_frac"),
        F.median(F.when(band, rel)).alias("bar"), F.count_if(band & (rel < bar_max)).alias("n_periods"),
        F.median(F.when(band & (F.col("rho") > 0), F.col("rho_err") / F.col("rho"))).alias("rho_bar"),
        F.min(F.when(held, F.col("period"))).alias("held_lo_s"), F.max(F.when(held, F.col("period"))).alias("held_hi_s"),
        F.count_if(held).alias("held_n"))
    g = g.withColumns({"pass_phase": F.coalesce(F.col("phase_frac") >= quadrant_min, F.lit(False)),
                       "pass_slope": F.coalesce(F.col("slope_frac") >= slope_min, F.lit(False)),
                       "pass_error": F.coalesce((F.col("bar") <= bar_max) & (F.col("n_periods") >= min_periods), F.lit(False))})
    fails = F.concat_ws("; ", F.when(~F.col("pass_phase"), "phase"), F.when(~F.col("pass_slope"), "slope"), F.when(~F.col("pass_error"), "error"))
    return g.withColumns({"passes": F.col("pass_phase") & F.col("pass_slope") & F.col("pass_error"), "fails": fails})


def readings_table(tf: DataFrame, station: list[str], name: str, kind: str, candidate: str | None = None,
                   lo: float = 10.0, hi: float = 1000.0, band=curves.AGREE_BAND, **tests) -> DataFrame:
    """Every curve's tests and the number of other reference kinds that pass and agree with it.

    `station` holds the columns curves are compared within, `name` the one naming a curve.
    """
    keys = [*station, name]
    q = response_tests(tf, keys, lo, hi, **tests)
    facts = tf.groupBy(*keys).agg(F.first(kind).alias("_kind"), *([F.first(candidate).alias("candidate")] if candidate else []))
    q = q.join(facts, keys)
    if not candidate:
        q = q.withColumn("candidate", F.lit(True))
    sound = q.where("passes").select(*station, name, F.col("_kind").alias("_k"), "candidate")
    a = sound.select(*station, F.col(name).alias("a"), F.col("_k").alias("ka"))
    b = sound.where("candidate").select(*station, F.col(name).alias("b"), F.col("_k").alias("kb"))
    pairs = a.join(b, station).where((F.col("a") != F.col("b")) & (F.col("ka") != F.col("kb")))
    pts = curves.paired(tf, pairs.select(*station, "a", "b"), station, name, "clamp", band[0], band[1])
    ok = curves.agreement(pts, [*station, "a", "b"]).where("agrees").join(pairs, [*station, "a", "b"])
    # at most one entry per reference kind
    n = ok.groupBy(*station, F.col("a").alias(name)).agg(F.array_join(F.array_sort(F.collect_set("kb")), " ").alias("agree_kinds"),
                                                         F.countDistinct("kb").alias("agree_n"))
    return q.join(n, keys, "left").withColumns({"agree_kinds": F.coalesce("agree_kinds", F.lit("")), "agree_n": F.coalesce("agree_n", F.lit(0))}).drop("_kind")


def unique_names(readings: DataFrame, station: list[str], name: str, run: str, path: str) -> DataFrame:
    """A name shared by two files of one station carries its run."""
    files = readings.groupBy(*station, name).agg(F.countDistinct(path).alias("_f"))
    return readings.join(files, [*station, name]).withColumn(
        name, F.when(F.col("_f") > 1, F.concat(F.col(name), F.lit("@"), F.col(run))).otherwise(F.col(name))).drop("_f")


def response_of_record(readings: DataFrame, station: list[str], name: str) -> DataFrame:
    """The chosen curve per station and component, or `none` with the reason there is none.

    Passing rows that another kind corroborates compete; the smallest bar wins, ties by the longest period held.
    """
    ok = F.col("passes") & F.coalesce(F.col("candidate"), F.lit(True))
    pool = ok & (F.col("agree_n") > 0)
    pick = F.min(F.when(pool, F.struct(F.round("bar", 12).alias("bar"), (-F.col("held_hi_s")).alias("neg"), F.col(name).alias("name"))))
    g = readings.groupBy(*station).agg(pick.alias("_p"), F.count_if(ok).alias("n_sound"), F.count_if(pool).alias("n_pool"), F.count(F.lit(1)).alias("n_read"))
    why = (F.when(F.col("n_pool") > 0, "the smallest bar among the rows that pass and agree with another kind")
           .when(F.col("n_sound") > 0, "rows pass and none agrees with another kind").otherwise("no row passes the three tests"))
    return g.select(*station, F.coalesce(F.col("_p.name"), F.lit("none")).alias("response"), F.col("_p.bar").alias("bar"), "n_sound", "n_pool", "n_read", why.alias("why"))


def alternatives(readings: DataFrame, station: list[str], name: str) -> DataFrame:
    """The passing rows of each station and component with their rank by bar, best first."""
    w = Window.partitionBy(*station).orderBy("bar", name)
    return readings.where("passes").withColumn("rank", F.row_number().over(w)).select(*station, name, "bar", "rank")


def deliverable(rows: DataFrame, kind: str, is_form, form: str) -> DataFrame:
    """Every row with why it is not delivered, '' where it is."""
    f = F.coalesce(F.col(form), F.lit(""))
    return rows.withColumn("why", F.when(F.col(kind) == "single", "the single reference kind is never delivered")
                           .when((f != "") & ~is_form(f), "a form no section makes").otherwise(""))


def agreement_counts(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Pairs that agree on every component, and the worst ratio: one row per group.

    `pairs` has one row per (by, a, b, comp).
    """
    both = pairs.groupBy(*by, "a", "b").agg(F.bool_and("agrees").alias("_ok"))
    worst = pairs.groupBy(*by).agg(F.max_by("rho_ratio", F.struct(F.round(F.abs(F.log("rho_ratio")), 12), F.col("a"), F.col("b"))).alias("worst_rho_ratio"))
    return both.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), F.count_if("_ok").alias("agreeing")).join(worst, by)


def choice_in_force(targets: DataFrame, keys: list[str], choices: DataFrame, cell: str, rule: str, readings: DataFrame, name: str = "tf", bar: str = "bar") -> DataFrame:
    """Whose choice stands for every target and the reading that it names: the analyst's row, then the cell, then the rule.

    Columns: keys, name, chosen_by, bar (the smallest of several readings of that name), matched, departs (from the rule). `cell` and `rule`
    are columns of `targets`; a name that picks out no reading stays, unmatched.
    """
    a = choices.where(F.lower("chosen_by") == "analyst").groupBy(*keys).agg(F.max(name).alias("_a"))
    d = targets.join(a, keys, "left")
    held = F.coalesce(F.trim(F.col(cell)), F.lit("")) != ""
    d = d.select(*keys, F.coalesce("_a", F.when(held, F.col(cell)), F.col(rule)).alias(name),
                 F.when(F.col("_a").isNotNull(), "analyst").when(held, "cell").otherwise("rule").alias("chosen_by"), F.col(rule).alias("_rule"))
    r = readings.where("status = 'ok'").groupBy(*keys, name).agg(F.min(bar).alias(bar))
    return d.join(r, [*keys, name], "left").select(*keys, name, "chosen_by", bar, F.col(bar).isNotNull().alias("matched"), (F.col(name) != F.col("_rule")).alias("departs"))
