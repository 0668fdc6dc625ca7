"""Joining a short-period curve to a long-period one: the rate gate, the control gate, the choice and the join."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from . import curves

# fixed thresholds
JOIN_S = 16.0
FLOOR_S = 0.6
STEP_BELOW = (8.0, 16.0)
STEP_ABOVE = (32.0, 100.0)
LEVEL_BAND = (4.0, 32.0)
SHORT_BAR_BAND = (2.0, 10.0)
CONTROL_BAND = (2.0, 16.0)
MAX_STEP_PCT = 2.0
LEVEL_MAX_PCT = 5.0
SHORT_BAR_MAX = 0.25
RATE_MAX_PCT = 4.0
CONTROL_MARGIN = 0.20
MIN_POINTS = 2
KEY_DP = 6


def level_pct(points: DataFrame, keys: list[str], lo: float, hi: float, out: str) -> DataFrame:
    """100 (median rho ratio - 1) of the short curve over the base at the base's periods in a closed band."""
    d = points.where((F.col("period") >= lo) & (F.col("period") <= hi))
    g = d.groupBy(*keys).agg(F.median("ratio").alias("_r"), F.count(F.lit(1)).alias("_n"), F.max("n_b").alias("_b"))
    return g.select(*keys, F.when((F.col("_n") >= MIN_POINTS) & (F.col("_b") >= MIN_POINTS), 100.0 * (F.col("_r") - 1)).alias(out))


def step_at_join(points: DataFrame, keys: list[str], below=STEP_BELOW, above=STEP_ABOVE, level=LEVEL_BAND) -> DataFrame:
    """The step the short curve would make on the band each side of the join, the worse of the two, and its level."""
    d = points.select(*keys).distinct()
    for band, name in ((below, "step_below_pct"), (above, "step_above_pct"), (level, "level_pct")):
        d = d.join(level_pct(points, keys, band[0], band[1], name), keys, "left")
    lo, hi = F.col("step_below_pct"), F.col("step_above_pct")
    worse = F.when(hi.isNull(), lo).when(lo.isNull(), hi).when(F.abs(hi) > F.abs(lo), hi).otherwise(lo)
    return d.withColumn("step_pct", worse)


def rate_gate(levels: DataFrame, by: list[str], site: str, pct: str = "rate_pct", max_pct: float = RATE_MAX_PCT,
              in_gate=None) -> DataFrame:
    """Per component the survey's median rate effect, its worst, the spread across kinds and whether it may be joined."""
    g = levels.where(F.col(pct).isNotNull() & (F.lit(True) if in_gate is None else in_gate))
    spread = g.groupBy(*by, site).agg(F.count(F.lit(1)).alias("_n"), (F.max(pct) - F.min(pct)).alias("_s"))
    spread = spread.groupBy(*by).agg(F.median(F.when(F.col("_n") > 1, F.col("_s"))).alias("kind_spread_pct"))
    top = g.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.median(pct).alias("rate_pct_median"),
                             F.max_by(F.col(pct), F.struct(F.round(F.abs(pct), 12), F.col(pct))).alias("rate_pct_worst"))
    return top.join(spread, by).withColumn("can_splice", F.abs("rate_pct_median") <= max_pct)


def control_gate(bars: DataFrame, within: list[str], selection: str, bar: str = "bar", margin: float = CONTROL_MARGIN,
                 whole: str = "whole", control: str = "control") -> DataFrame:
    """Whether each selection beats its own control by the margin; whole is admitted, the control never is."""
    c = bars.where(F.col(selection) == control).select(*within, F.col(bar).alias("control_bar"))
    d = bars.join(c, within, "left")
    s, own, ctl = F.col(selection), F.col(bar), F.col("control_bar")
    wins = own <= (1.0 - margin) * ctl
    return d.withColumns({
        "eligible": F.when(s == whole, True).when(s == control, False).otherwise(F.coalesce(wins & (ctl > 0), F.lit(False))),
        "verdict": F.when(s == whole, "whole").when(s == control, "control").when(own.isNull() | ctl.isNull() | (ctl <= 0), "UNJUDGED")
        .when(wins, "beats").otherwise("does not beat")})


def choose_short(scored: DataFrame, station: list[str], name: str, comp: str = "comp") -> DataFrame:
    """The short curve each component is joined to, or none with the first gate that stopped it.

    xy by the smallest level departure within its ceiling, yx by the smallest short-end bar.
    """
    ok = F.col("passes") & F.col("eligible")
    step = F.coalesce(F.abs("step_pct") <= MAX_STEP_PCT, F.lit(False))
    short = F.coalesce(F.col("short_bar") <= SHORT_BAR_MAX, F.lit(False))
    level = F.coalesce(F.abs("level_pct") <= LEVEL_MAX_PCT, F.lit(False))
    fit = ok & step & short & ((F.col(comp) == "yx") | level)
    key = F.when(F.col(comp) == "xy", F.abs("level_pct")).otherwise(F.col("short_bar"))
    g = scored.groupBy(*station, comp).agg(
        F.min(F.when(fit, F.struct(F.round(key, 12).alias("k"), F.col(name).alias("name")))).alias("_p"), F.count_if("passes").alias("_np"),
        F.count_if(ok).alias("_no"), F.count_if(ok & step).alias("_ns"), F.count_if(ok & step & short).alias("_nb"))
    why = (F.when(F.col("_p").isNotNull(), "joined").when(F.col("_np") == 0, "no short row passes the response tests")
           .when(F.col("_no") == 0, "no row holds the control gate").when(F.col("_ns") == 0, "no row holds the step at the join")
           .when(F.col("_nb") == 0, "the short-end bar is over the ceiling").otherwise("no row holds its level"))
    return g.select(*station, comp, F.coalesce(F.col("_p.name").cast("string"), F.lit("none")).alias("pick"), why.alias("why"))


def union_grid(base: DataFrame, short: DataFrame, keys: list[str], floor: float = FLOOR_S, join: float = JOIN_S) -> DataFrame:
    """Base periods and the short periods in [floor, join), one per rounded key, keeping the original base value."""
    a = base.select(*keys, "period").withColumn("_o", F.lit(0))
    b = short.where((F.col("period") >= floor) & (F.col("period") < join)).select(*keys, "period").withColumn("_o", F.lit(1))
    return (a.unionByName(b).groupBy(*keys, F.round("period", KEY_DP).alias("_k"))
            .agg(F.min_by("period", F.struct("_o", "period")).alias("period")).drop("_k"))


def splice(base: DataFrame, short: DataFrame, picked: DataFrame, keys: list[str], floor: float = FLOOR_S, join: float = JOIN_S) -> DataFrame:
    """Short rows below the join for the picked components, base rows everywhere else: a union on the long table.

    `picked` is (keys, comp). A component that was not picked keeps every base row as it is.
    """
    kc = [*keys, "comp"]
    above = base.join(picked.withColumn("_p", F.lit(1)), kc, "left").where(F.col("_p").isNull() | (F.col("period") >= join)).drop("_p")
    below = short.join(picked, kc, "left_semi").where((F.col("period") >= floor) & (F.col("period") < join))
    return above.withColumn("source", F.lit("base")).unionByName(below.withColumn("source", F.lit("short")))


def unchanged(before: DataFrame, after: DataFrame, keys: list[str], tol: float = 1e-12) -> DataFrame:
    """Per component: rows lost and the worst relative change of what must have come through untouched."""
    b = before.select(*keys, "comp", F.round("period", KEY_DP).alias("_k"), "re", "im")
    a = after.select(*keys, "comp", F.round("period", KEY_DP).alias("_k"), F.col("re").alias("re2"), F.col("im").alias("im2"))
    j = b.join(a, [*keys, "comp", "_k"], "left")
    d = F.sqrt(F.pow(F.col("re") - F.col("re2"), 2) + F.pow(F.col("im") - F.col("im2"), 2)) / F.greatest(
        F.sqrt(F.pow("re", 2) + F.pow("im", 2)), F.lit(1e-30))
    g = j.groupBy(*keys, "comp").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("re2").isNull()).alias("n_lost"), F.coalesce(F.max(d), F.lit(0.0)).alias("worst_relative"))
    return g.withColumn("ok", (F.col("n_lost") == 0) & (F.col("worst_relative") <= tol))


def first_delivered(tf: DataFrame, keys: list[str]) -> DataFrame:
    """The shortest period at which each delivered row carries a value."""
    return tf.where(F.col("re").isNotNull()).groupBy(*keys, "comp").agg(F.min("period").alias("first_period"), F.count(F.lit(1)).alias("n_periods"))


def worst_change(pairs: DataFrame, by: list[str], ratio: str = "rho_ratio") -> DataFrame:
    """The largest change per group by |log ratio|."""
    w = Window.partitionBy(*by).orderBy(F.desc(F.round(F.abs(F.log(ratio)), 12)), "a", "b", "comp")
    return pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


__all__ = ["level_pct", "step_at_join", "rate_gate", "control_gate", "choose_short", "union_grid", "splice", "unchanged",
           "first_delivered", "worst_change", "curves"]
