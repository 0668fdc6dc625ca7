"""Which hours: runs above a score, the best stretch, its random control and the verdict the mask gives both."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import islands
from .blocks import BLK, trim_halo, with_halo

COH_MIN = 0.5
MAX_HOURS = 48
HOUR_BLOCK = 4096


def above(lines: list[str], coh_min: float) -> Column:
    """Every named line is present and reads above `coh_min`."""
    ok = F.lit(True)
    for c in lines:
        ok = ok & F.coalesce(F.col(c) > coh_min, F.lit(False))
    return ok


def row_score(lines: list[str]) -> Column:
    """The mean of the named lines that are present."""
    total, n = F.lit(0.0), F.lit(0)
    for c in lines:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
        n = n + F.col(c).isNotNull().cast("int")
    return F.when(n > 0, total / n)


def runs_above(scores: DataFrame, keys: list[str], hour: str, lines: list[str], coh_min: float = COH_MIN,
               block: int = HOUR_BLOCK) -> DataFrame:
    """Contiguous hours in which every named line is above `coh_min`."""
    return islands.runs(scores, keys, hour, above(lines, coh_min), block=block)


def longest_stretch(scores: DataFrame, keys: list[str], hour: str, lines: list[str], coh_min: float = COH_MIN,
                    max_hours: int = MAX_HOURS, block: int = HOUR_BLOCK) -> DataFrame:
    """Per key the longest run, cut to its best `max_hours` contiguous hours where it is longer.

    The earliest run wins a tie, and inside a long run the first window of the highest mean does. A key with no
    hour above the threshold keeps its row, with no bounds and the reason.
    """
    s = scores.select(*keys, F.col(hour).cast("bigint").alias(hour), row_score(lines).alias("_sc"),
                      above(lines, coh_min).alias("_ok"))
    counts = s.groupBy(*keys).agg(F.count("_sc").alias("n_scored"), F.count_if("_ok").alias("n_above"))
    r = islands.runs(s, keys, hour, F.col("_ok"), block=block)
    best = (r.groupBy(*keys).agg(F.max(F.struct(F.col("run_len").alias("len"), (-F.col("run_start")).alias("neg"),
                                                F.col("run_end").alias("end"))).alias("_b"),
                                 F.count(F.lit(1)).alias("n_runs"))
            .select(*keys, "n_runs", F.col("_b.len").alias("_len"), (-F.col("_b.neg")).alias("_a"),
                    F.col("_b.end").alias("_z")))
    # mean of the next max_hours scores, only where the whole window lies inside the chosen run
    inside = (s.join(best, keys).where((F.col(hour) >= F.col("_a")) & (F.col(hour) <= F.col("_z"))))
    h = with_halo(inside, hour, block, 0, max_hours - 1)
    w = Window.partitionBy(*keys, BLK).orderBy(hour).rowsBetween(0, max_hours - 1)
    h = trim_halo(h.withColumn("_m", F.avg("_sc").over(w)), hour, block)
    fits = (F.col(hour) + (max_hours - 1)) <= F.col("_z")
    # means that agree to 12 decimals are one mean, so the first window wins whatever order the sums ran in
    pick = F.max(F.when(fits, F.struct(F.round("_m", 12).alias("m"), (-F.col(hour)).alias("neg"))))
    got = (h.groupBy(*keys).agg(pick.alias("_p"), F.avg("_sc").alias("_mean"), F.first("_a").alias("_a"),
                                F.first("_z").alias("_z"), F.first("_len").alias("_len"), F.first("n_runs").alias("n_runs")))
    cut = F.col("_len") > max_hours
    got = got.select(*keys, "n_runs", cut.alias("cut"),
                     F.when(cut, -F.col("_p.neg")).otherwise(F.col("_a")).alias("t_start"),
                     F.when(cut, -F.col("_p.neg") + max_hours).otherwise(F.col("_z") + 1).alias("t_end"),
                     F.when(cut, F.col("_p.m")).otherwise(F.col("_mean")).alias("mean_score"))
    why = F.when(F.col("t_start").isNull(), F.lit("no hour reads above the threshold on every named line")) \
        .when(F.col("cut"), F.lit("the best hours inside the longest contiguous run")) \
        .otherwise(F.lit("the longest contiguous run"))
    return (counts.join(got, keys, "left")
            .withColumns({"n_runs": F.coalesce("n_runs", F.lit(0)), "cut": F.coalesce("cut", F.lit(False)),
                          "hours": F.coalesce(F.col("t_end") - F.col("t_start"), F.lit(0))})
            .withColumn("reason", why))


def control_stretch(stretch: DataFrame, spans: DataFrame, keys: list[str], seed: int = 0, lo: str = "t0",
                    hi: str = "t1") -> DataFrame:
    """A run of the same number of whole hours elsewhere in the record, clear of the selection.

    The draw is the start with the smallest md5 of (seed, key, start): seeded and reproducible in any engine.
    Where no placement is clear the row carries the reason instead of bounds.
    """
    d = stretch.where(F.col("t_start").isNotNull()).select(*keys, "t_start", "t_end", "hours")
    d = d.join(spans.select(*keys, F.col(lo).alias("_lo"), F.col(hi).alias("_hi")), keys)
    c = d.withColumn("_t", F.explode(F.sequence(F.col("_lo"), F.greatest(F.col("_lo"), F.col("_hi") - F.col("hours")))))
    end = F.col("_t") + F.col("hours")
    free = (end <= F.col("_hi")) & ((end <= F.col("t_start")) | (F.col("_t") >= F.col("t_end")))
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys], F.col("_t").cast("string")))
    g = c.groupBy(*keys, "hours").agg(F.min_by(F.col("_t"), F.when(free, draw)).alias("_t"), F.count_if(free).alias("n_free"))
    has = F.col("n_free") > 0
    return g.select(*keys, F.when(has, F.col("_t")).alias("t_start"), F.when(has, F.col("_t") + F.col("hours")).alias("t_end"),
                    F.when(has, F.col("hours")).otherwise(F.lit(0)).alias("hours"), "n_free",
                    F.when(has, "a run of the same whole hours elsewhere").otherwise(
                        "the record holds no second run of that length clear of the selection").alias("reason"))


def verdict(stretch: DataFrame, kept: DataFrame, keys: list[str], pos: str, scale: int, min_run: int,
            block: int) -> DataFrame:
    """Runs of at least `min_run` samples the keep mask leaves inside each stretch; none refuses the stretch.

    `kept` has one row per kept sample position and `scale` positions make one hour of the stretch.
    """
    b = stretch.where(F.col("t_start").isNotNull()).select(*keys, (F.col("t_start") * scale).alias("_a"),
                                                           (F.col("t_end") * scale).alias("_z"))
    inside = kept.join(b, keys).where((F.col(pos) >= F.col("_a")) & (F.col(pos) < F.col("_z")))
    r = islands.runs(inside, keys, pos, min_len=min_run, block=block).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_runs_kept"), F.sum("run_len").alias("kept_samples"))
    out = stretch.join(r, keys, "left").withColumns({
        "n_runs_kept": F.coalesce("n_runs_kept", F.lit(0)), "kept_samples": F.coalesce("kept_samples", F.lit(0))})
    return out.withColumn("refused", F.when(F.col("t_start").isNull(), F.lit("no stretch"))
                          .when(F.col("n_runs_kept") == 0, F.lit("the mask leaves no whole run inside the stretch"))
                          .otherwise(F.lit("")))


def quiet_window(samples: DataFrame, keys: list[str], pos: str, target: str, others: list[str], step: int) -> DataFrame:
    """The whole window of `step` samples, every series present, in which the target varies least."""
    full = F.col(target).isNotNull()
    for c in others:
        full = full & F.col(c).isNotNull()
    from .blocks import block_of
    w = (samples.where(full).groupBy(*keys, block_of(pos, step).alias("slot"))
         .agg(F.count(F.lit(1)).alias("_n"), F.stddev_pop(target).alias("std")).where(F.col("_n") == step))
    return w.groupBy(*keys).agg(F.min(F.struct(F.round("std", 9).alias("std"), F.col("slot").alias("slot"))).alias("_b"),
                                F.count(F.lit(1)).alias("n_whole")).select(
        *keys, F.col("_b.slot").alias("slot"), F.col("_b.std").alias("std"), "n_whole")


def spread_windows(windows: DataFrame, keys: list[str], order: str, max_windows: int = 8) -> DataFrame:
    """At most `max_windows` rows per key, spread evenly over the ordered list rather than taken from its head."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = windows.withColumn("_k", F.row_number().over(w) - 1).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    # position k is picked by j when k = round-half-even(j * (n - 1) / (m - 1))
    picks = F.transform(F.sequence(F.lit(0), F.lit(max_windows - 1)),
                        lambda j: F.bround(j * (F.col("_n") - 1) / F.lit(float(max_windows - 1)), 0).cast("int"))
    return d.where((F.col("_n") <= max_windows) | F.array_contains(picks, F.col("_k"))).drop("_k", "_n")


def run_windows(r: DataFrame, keys: list[str], win: int) -> DataFrame:
    """Every disjoint whole window of `win` positions inside each run, from the run's own start."""
    n = F.floor(F.col("run_len") / win)
    return (r.where(n >= 1).withColumn("_j", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
            .select(*keys, (F.col("run_start") + F.col("_j") * win).alias("w_start"),
                    (F.col("run_start") + F.col("_j") * win + win).alias("w_end")))


def longest_state_run(days: DataFrame, keys: list[str], day: str, state: str, t_start: str, t_end: str,
                      states: list[str], fallback: list[str], min_days: float = 0.5, day_len: int = 86400,
                      block: int = HOUR_BLOCK) -> DataFrame:
    """The longest run of table rows whose state is wanted; where none reaches the floor the fallback set is tried.

    `day` numbers the rows of the table, so a run is over scored rows. Earliest on a tie.
    """
    def best(want: list[str], tag: str) -> DataFrame:
        r = islands.runs(days, keys, day, F.col(state).isin(want), block=block)
        b = r.groupBy(*keys).agg(F.max(F.struct(F.col("run_len").alias("n"), (-F.col("run_start")).alias("neg"),
                                                F.col("run_end").alias("z"))).alias("_b"))
        b = b.select(*keys, F.col("_b.n").alias("_n"), (-F.col("_b.neg")).alias("_s"), F.col("_b.z").alias("_z"))
        a = days.select(*keys, F.col(day).alias("_s"), F.col(t_start).alias("_ta"))
        z = days.select(*keys, F.col(day).alias("_z"), F.col(t_end).alias("_tb"))
        return (b.join(a, [*keys, "_s"]).join(z, [*keys, "_z"])
                .where((F.col("_tb") - F.col("_ta")) / float(day_len) >= min_days)
                .select(*keys, F.lit(tag).alias("rule"), F.col("_ta").alias("t_start"), F.col("_tb").alias("t_end"),
                        F.col("_n").alias("n_days")))
    first = best(states, "states")
    second = best(fallback, "fallback").join(first.select(*keys), keys, "left_anti")
    none = days.select(*keys).distinct()
    out = none.join(first.unionByName(second), keys, "left")
    return out.withColumn("rule", F.coalesce("rule", F.lit("none"))).withColumn("n_days", F.coalesce("n_days", F.lit(0)))
