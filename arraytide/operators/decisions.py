"""Decisions applied to records, and the daily and whole-record tests the decisions are made from."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cells, rotation
from . import intervals, robust
from .axis import AXIS_BLOCK

# fixed thresholds
F_GAIN_TOL = 0.05
TILT_TOL = 0.10
ANGLE_TOL_DEG = 30.0
SIGN_FLOOR = 0.3
DEAD_FRACTION = 0.2
SOUND_COH, SOUND_EX_EY_MAX = 0.4, 0.5
COMMON_EX_EY, COMMON_COH_MAX = 0.6, 0.3
STATES = ("sound", "weak", "common", "dead", "gap")
SIGN_OF = {"hx": "sign_hx", "hy": "sign_hy", "hz": "sign_hz", "ex": "sign_ex", "ey": "sign_ey"}


def decision_values(decisions: DataFrame, key: str) -> DataFrame:
    """The typed reading of every decision cell, with the list of open ones."""
    c = F.col
    n = decisions.select(key, cells.yes_no(c("e_exchange")).alias("xe"), cells.yes_no(c("h_exchange")).alias("xh"),
                         cells.number(c("h_gain"), 1.0).alias("g"), cells.number(c("e_shift_s"), 0.0).alias("s"),
                         *[cells.sign(c(col)).alias("s_" + ch) for ch, col in SIGN_OF.items()], cells.name(c("h_lender")).alias("lender"),
                         cells.lender_channels(c("h_lender_channels")).alias("lender_channels"),
                         (cells.low(c("h_lender")).isin("", "nan", "<na>", "decide")).alias("_lo"),
                         cells.length(c("dipole_n_m"))["value"].alias("ln"), cells.length(c("dipole_e_m"))["value"].alias("le"))
    opened = F.array_compact(F.array(F.when(~c("xe.decided"), "e_exchange"), F.when(~c("xh.decided"), "h_exchange"), F.when(~c("g.decided"), "h_gain"),
                                     F.when(~c("s.decided"), "e_shift_s"), *[F.when(~c(f"s_{ch}.decided"), SIGN_OF[ch]) for ch in SIGN_OF], F.when(c("_lo"), "h_lender")))
    return n.withColumn("open", opened)


def apply_decisions(samples: DataFrame, values: DataFrame, key: str, pos: str, fs: float = 1.0, lender: DataFrame | None = None,
                    block: int = AXIS_BLOCK) -> DataFrame:
    """The five channels with every decision applied, in one fixed order.

    Electric lines exchanged and rescaled by the arms, magnetic ones exchanged, gain, Lanczos shift of the lines,
    signs, then the lender's channels turned into this station's sensor frame. `values` is one row per station.
    `lender` is already decided, rotated and on this axis: (key, pos, l_hx, l_hy, l_hz).
    """
    c = F.col
    v = values.select(key, "xe", "xh", "g", "s", *["s_" + ch for ch in SIGN_OF], "lender", "lender_channels", "ln", "le")
    d = samples.join(v, key)
    arms = F.coalesce((c("ln") > 0) & (c("le") > 0), F.lit(False))
    fx, fy = F.when(arms, c("le") / c("ln")).otherwise(1.0), F.when(arms, c("ln") / c("le")).otherwise(1.0)
    d = d.withColumns({"ex": F.when(c("xe.value"), c("ey") * fx).otherwise(c("ex")), "ey": F.when(c("xe.value"), c("ex") * fy).otherwise(c("ey")),
                       "hx": F.when(c("xh.value"), c("hy")).otherwise(c("hx")), "hy": F.when(c("xh.value"), c("hx")).otherwise(c("hy"))})
    gain = c("g.decided") & ~c("g.value").isin(0.0, 1.0)
    d = d.withColumns({h: F.when(gain, c(h) / c("g.value")).otherwise(c(h)) for h in ("hx", "hy", "hz")})
    # the shift reads neighbouring samples, so only the stations that have one go through it
    moved = c("s.decided") & (c("s.value") != 0)
    still = d.where(~moved)
    go = d.where(moved).withColumn("_delay", c("s.value") * fs)
    lines = go.select(key, pos, "_delay", "ex", "ey")
    for e in ("ex", "ey"):
        one = robust.shift(lines.select(key, pos, "_delay", F.col(e).alias("v")), [key], pos, "v", c("_delay"), block).select(key, pos, F.col("v").alias(e))
        go = go.drop(e).join(one, [key, pos], "left")
    d = still.unionByName(go.drop("_delay").select(still.columns))
    d = d.withColumns({ch: c(ch) * c(f"s_{ch}.value") for ch in SIGN_OF})
    if lender is not None:
        ang = d.groupBy(key).agg(F.coalesce(rotation.mean_field_angle("hx", "hy"), F.lit(0.0)).alias("_ang"))
        d = d.join(ang, key).join(lender, [key, pos], "left")
        sx, sy = rotation.to_sensor(c("l_hx"), c("l_hy"), c("_ang"))
        took = lambda ch: (c("lender") != "") & F.array_contains("lender_channels", ch)
        d = d.withColumns({"hx": F.when(took("hx"), sx).otherwise(c("hx")), "hy": F.when(took("hy"), sy).otherwise(c("hy")),
                           "hz": F.when(took("hz"), c("l_hz")).otherwise(c("hz"))})
    return d.select(*samples.columns)


def applied_log(values: DataFrame, key: str) -> DataFrame:
    """What was applied to each station, in order, and what is still open."""
    c = F.col
    done = F.array_compact(F.array(F.when(c("xe.value"), "e_exchange"), F.when(c("xh.value"), "h_exchange"),
                                   F.when(c("g.decided") & ~c("g.value").isin(0.0, 1.0), "h_gain"), F.when(c("s.decided") & (c("s.value") != 0), "e_shift_s"),
                                   *[F.when(c(f"s_{ch}.value") < 0, SIGN_OF[ch]) for ch in SIGN_OF], F.when(c("lender") != "", "h_lender")))
    both = (c("lender") != "") & F.array_contains("lender_channels", "hx") & F.array_contains("lender_channels", "hy")
    return values.select(key, F.array_join(done, " ").alias("applied"), F.array_join("open", " ").alias("open"), both.alias("inter_site"))


def rotate_to_mean_field(samples: DataFrame, keys: list[str], pos: str, regimes: DataFrame | None = None, drop: DataFrame | None = None) -> DataFrame:
    """hx, hy turned into the mean-field frame, per regime where any are named, with the angle used.

    `regimes` and `drop` are (keys, p0, p1) position ranges, an open p1 NULL. Dropped samples are NULL and enter
    no mean; a sample of a station with regimes that lies in none of them is NULL too. A station has a few regimes.
    """
    d = samples
    if drop is not None:
        # a station may drop thousands of days: ranges meet samples slot by slot, an open one ends with the record
        ends = samples.groupBy(*keys).agg((F.max(pos) + 1).alias("_end"))
        ranges = drop.join(ends, keys).select(*keys, "p0", F.coalesce("p1", "_end").alias("p1"))
        d = intervals.mark(d, ranges, keys, pos, "p0", "p1", "_out")
        d = d.withColumns({c: F.when(~F.col("_out"), F.col(c)) for c in ("hx", "hy")}).drop("_out")
    d = d.withColumn("_reg", F.lit(0))
    if regimes is not None:
        g = regimes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("p0", "p1"))).alias("_rg"))
        d = d.join(g, keys, "left")
        inside = F.transform("_rg", lambda r: (F.col(pos) >= r["p0"]) & (r["p1"].isNull() | (F.col(pos) < r["p1"])))
        d = d.withColumn("_reg", F.when(F.col("_rg").isNull(), 0).otherwise(F.array_position(inside, True).cast("int"))).withColumn(
            "_reg", F.when(F.col("_rg").isNotNull() & (F.col("_reg") == 0), -1).otherwise(F.col("_reg"))).drop("_rg")
    ang = d.groupBy(*keys, "_reg").agg(rotation.mean_field_angle("hx", "hy").alias("angle"))
    d = d.join(ang.where(F.col("_reg") >= 0), [*keys, "_reg"], "left")
    x, y = rotation.rotate_pair(F.col("hx"), F.col("hy"), F.col("angle"))
    return d.withColumns({"hx": x, "hy": y}).drop("_reg")


# ---------------------------------------------------------------- the tests

def dc_test(medians: DataFrame) -> DataFrame:
    """The record's DC field against the model field columns igrf_x, igrf_y, igrf_z: ratios, flags, verdict.

    `medians` is one row per station with bx, by, bz.
    """
    c = F.col
    h, f = F.sqrt(c("bx") ** 2 + c("by") ** 2), F.sqrt(c("bx") ** 2 + c("by") ** 2 + c("bz") ** 2)
    hi, fi = F.sqrt(c("igrf_x") ** 2 + c("igrf_y") ** 2), F.sqrt(c("igrf_x") ** 2 + c("igrf_y") ** 2 + c("igrf_z") ** 2)
    d = medians.withColumns({"f_ratio": F.try_divide(f, fi), "h_ratio": F.try_divide(h, hi), "bx_over_x": F.try_divide("bx", "igrf_x"),
                             "bz_over_z": F.try_divide("bz", "igrf_z"),
                             "angle_deg": F.degrees(F.atan2("by", "bx")),
                             "tilt_deg": F.degrees(F.atan2(h, -c("bz")) - F.atan2(hi, -c("igrf_z")))})
    flags = F.array_compact(F.array(
        F.when(F.abs(c("f_ratio") - 1) > F_GAIN_TOL, "gain").when((F.abs(c("bz_over_z") - 1) > TILT_TOL) | (F.abs(c("h_ratio") - 1) > TILT_TOL), "tilt"),
        F.when(c("bx") < 0, "Bx negative"), F.when(F.abs("angle_deg") > ANGLE_TOL_DEG, "angle")))
    return d.withColumn("flags", F.array_join(flags, "; ")).withColumn("verdict", F.when(F.size(flags) == 0, "PASS").otherwise("CHECK"))


def dc_flags(flags: Column) -> Column:
    """The flags that disqualify a sign reading: all but `Bx negative`."""
    return F.filter(F.transform(F.split(flags, ";"), lambda x: F.trim(x)), lambda x: (x != "") & (x != "Bx negative"))


def signs_from_dc(dc: DataFrame, key: str, floor: float = SIGN_FLOOR) -> DataFrame:
    """(key, column, value, reason): the sign of hx and hz by the floor rule, NULL where it is not judged."""
    suspect = F.size(dc_flags(F.col("flags"))) > 0
    def one(col: str, ratio: str):
        r = F.col(ratio)
        return F.struct(F.lit(col).alias("column"), F.when(~suspect & (F.abs(r) >= floor), F.when(r > 0, 1).otherwise(-1)).alias("value"),
                        F.when(suspect, "flagged").when(r.isNull(), "no ratio").when(F.abs(r) < floor, "inside the floor").otherwise("outside the floor").alias("reason"))
    return dc.select(key, F.explode(F.array(one("sign_hx", "bx_over_x"), one("sign_hz", "bz_over_z"))).alias("d")).select(key, "d.*")


def line_states(days: DataFrame, keys: list[str], lines: dict[str, str], dead_fraction: float = DEAD_FRACTION, dead_abs: float = 0.0) -> DataFrame:
    """Daily states of each line: `lines` maps a line to its coherence column; columns std_<line>, coh_ex_ey.

    The dead threshold is a share of the line's own median daily deviation; a record has one row per day.
    """
    thr = days.groupBy(*keys).agg(*[F.greatest(F.lit(dead_fraction) * F.median(f"std_{x}"), F.lit(dead_abs)).alias(f"dead_std_{x}") for x in lines])
    d = days.join(thr, keys)
    for x, coh in lines.items():
        s, e, h = F.col(f"std_{x}"), F.col("coh_ex_ey"), F.col(coh)
        d = d.withColumn(f"{x}_state", F.when(s.isNull(), "gap").when(s < F.col(f"dead_std_{x}"), "dead")
                         .when((h >= SOUND_COH) & (e < SOUND_EX_EY_MAX), "sound").when((e >= COMMON_EX_EY) & (h < COMMON_COH_MAX), "common").otherwise("weak"))
    return d


def line_summary(states: DataFrame, keys: list[str], lines: list[str], order: str) -> DataFrame:
    """Counts and fractions of each state over the scored days and the longest run of sound rows. One row per day in."""
    scored = F.lit(False)
    for x in lines:
        scored = scored | (F.col(f"{x}_state") != "gap")
    d = states
    for x in lines:
        w = Window.partitionBy(*keys).orderBy(order)
        ok = F.col(f"{x}_state") == "sound"
        d = d.withColumn("_g", F.sum(F.when(ok, 0).otherwise(1)).over(w))
        d = d.withColumn(f"_run_{x}", F.when(ok, F.count_if(ok).over(Window.partitionBy(*keys, "_g"))).otherwise(0))
    aggs = [F.count(F.lit(1)).alias("days_total"), F.count_if(scored).alias("days_scored")]
    for x in lines:
        aggs += [F.count_if(F.col(f"{x}_state") == s).alias(f"{x}_{s}") for s in STATES] + [F.max(f"_run_{x}").alias(f"{x}_longest_sound")]
    both = F.lit(True)
    for x in lines:
        both = both & (F.col(f"{x}_state") == "sound")
    g = d.groupBy(*keys).agg(*aggs, F.count_if(both).alias("both_sound"))
    n = F.greatest(F.lit(1), F.col("days_scored"))
    return g.withColumns({f"{x}_sound_frac": F.col(f"{x}_sound") / n for x in lines})


def sign_prediction(table: DataFrame, key: str, ex: str = "sign_ex", ey: str = "sign_ey") -> DataFrame:
    """(key, s_pred, undecided): the sign that the decided line signs predict, nothing where one of them is open."""
    x, y = cells.sign(F.col(ex)), cells.sign(F.col(ey))
    same = (x["value"] > 0) == (y["value"] > 0)
    und = F.array_compact(F.array(F.when(~x["decided"], "Ex"), F.when(~y["decided"], "Ey")))
    return table.select(key, F.when(F.size(und) == 0, F.when(same, 1.0).otherwise(-1.0)).alias("s_pred"), F.array_join(und, ", ").alias("undecided"))
