"""Reference series: members screened against each other, set on one level and stacked by weight.

Members come long, (target, member, i, x), already on the target's axis. A target has at most STACK_MAX members,
which is what bounds every per-sample group here.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .axis import AXIS_BLOCK
from .blocks import BLK, block_of, neighbours, trim_halo, with_halo
from .quantiles import group_mad

# fixed thresholds
SCREEN_K = 30.0
SCREEN_FLOOR = 3.0
SCREEN_PAD = (2, 3)
SCREEN_MAX_SPAN = 12
LEVEL_BLOCK = 60
LEVEL_WINDOW = 60
LEVEL_BLOCK_MIN_FRAC = 1.0 / 3.0
LEVEL_MIN_FRAC = 0.1
LEVEL_MIN_MEMBERS = 2
STACK_CUTOFF = 0.5
STACK_MAX = 8
STACK_MIN = 2
COH_MIN = 0.5
COH_RELAX = 0.3
MIN_OVERLAP_DAYS = 20.0

TM = ["target", "member"]


def member_steps(members: DataFrame, block: int = AXIS_BLOCK) -> DataFrame:
    """x[i] - x[i-1] of each member, and what the members do together at each sample."""
    d = with_halo(members, "i", block, 1, 0)
    w = Window.partitionBy(*TM, BLK).orderBy("i")
    d = trim_halo(d.withColumn("d", F.col("x") - F.lag("x").over(w)), "i", block)
    at = Window.partitionBy("target", "i")
    return d.withColumns({"nfin": F.count("d").over(at), "med": F.median("d").over(at),
                          "abs_sum": F.sum(F.abs("d")).over(at)})


def member_screen(members: DataFrame, k: float = SCREEN_K, floor: float = SCREEN_FLOOR, pad: tuple[int, int] = SCREEN_PAD,
                  max_span: int = SCREEN_MAX_SPAN, min_members: int = 2, block: int = AXIS_BLOCK) -> DataFrame:
    """Members with their own spikes bridged by a line, or blanked where the span is too long or its ends missing.

    Three or more members: a step that departs from their median by more than max(k MAD, floor) is flagged, so a
    spike the fleet shares stays. Exactly two: a step over the member's own threshold while the other stays under
    half the floor. Adds `flagged` (a sample of a padded span) and `bridged`.
    """
    # read three times below, twice to size the thresholds: worked out once and kept
    s = cut_lineage(member_steps(members, block))
    s = s.withColumn("r", F.when(F.col("nfin") >= max(3, min_members), F.col("d") - F.col("med")))
    mad = group_mad(s.where(F.col("r").isNotNull()), TM, "r").select(*TM, F.col("mad").alias("_m3"))
    own = group_mad(s.where(F.col("d").isNotNull()), TM, "d").select(*TM, F.col("mad").alias("_m2"))
    s = s.join(mad, TM, "left").join(own, TM, "left")
    thr = lambda m: F.greatest(F.lit(k) * F.col(m), F.lit(floor))
    three = F.abs("r") > thr("_m3")
    pair = F.lit(min_members <= 2) & (F.col("nfin") == 2) & (F.abs("d") > thr("_m2")) & ((F.col("abs_sum") - F.abs("d")) < 0.5 * floor)
    s = s.withColumn("hit", F.coalesce(three, F.lit(False)) | F.coalesce(pair, F.lit(False)))
    reach = max_span + sum(pad) + 1
    h = with_halo(s.select(*TM, "i", "x", "hit"), "i", block, reach, reach)
    w = Window.partitionBy(*TM, BLK).orderBy("i")
    h = h.withColumn("flagged", F.max("hit").over(w.rowsBetween(-pad[1], pad[0])))
    out = F.when(~F.col("flagged"), F.struct(F.col("i").alias("p"), F.col("x").alias("v")))
    h = h.withColumn("_b", F.last(out, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("_a", F.first(out, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    can = F.coalesce((F.col("_a.p") - F.col("_b.p") - 1) <= max_span, F.lit(False)) & F.col("_a.v").isNotNull() & F.col("_b.v").isNotNull()
    line = F.col("_b.v") + (F.col("_a.v") - F.col("_b.v")) * (F.col("i") - F.col("_b.p")) / (F.col("_a.p") - F.col("_b.p"))
    h = h.withColumn("bridged", F.col("flagged") & can)
    h = h.withColumn("x", F.when(~F.col("flagged"), F.col("x")).when(F.col("bridged"), line))
    return trim_halo(h, "i", block).select(*TM, "i", "x", "flagged", "bridged")


def fleet_level(members: DataFrame, min_members: int = LEVEL_MIN_MEMBERS) -> DataFrame:
    """(target, i, level): the median of the members at each sample that enough of them hold."""
    return (members.where(F.col("x").isNotNull()).groupBy("target", "i")
            .agg(F.median("x").alias("level"), F.count(F.lit(1)).alias("_n"))
            .select("target", "i", F.when(F.col("_n") >= min_members, F.col("level")).alias("level")))


def _offset(resid: DataFrame, keys: list[str], smooth: bool, t0: DataFrame, block: int, nwin: int, min_frac: float,
            axis_block: int) -> DataFrame:
    """(keys, i, off): block medians of `resid`, a centred running statistic, interpolated back to the samples.

    Samples are touched twice, to be summarised into blocks and to be given their block's value; the running
    window works on one row per block.
    """
    need_in = max(1, int(round(LEVEL_BLOCK_MIN_FRAC * block)))
    need = max(1, int(round(min_frac * nwin)))
    d = resid.join(t0, keys[:1]).withColumn("b", block_of(F.col("i") - F.col("t0"), block))
    nb = F.ceil(F.col("n") / block)
    med = d.where(F.col("r").isNotNull()).groupBy(*keys, "b", "t0", "n").agg(F.median("r").alias("_md"), F.count(F.lit(1)).alias("_n"))
    med = med.select(*keys, "b", F.when(F.col("_n") >= need_in, F.col("_md")).alias("m"))
    heads = d.select(*keys, "b", "t0", "n").distinct()
    blk = cut_lineage(heads.join(med, [*keys, "b"], "left").withColumn("nb", nb))
    lead_half = nwin // 2
    h = with_halo(blk, "b", max(axis_block // block, 4 * nwin), lead_half, nwin - 1 - lead_half)
    w = Window.partitionBy(*keys, BLK).orderBy("b").rangeBetween(-lead_half, nwin - 1 - lead_half)
    stat = F.avg("m").over(w) if smooth else F.percentile("m", 0.5).over(w)
    whole = (F.col("b") >= lead_half) & (F.col("b") <= F.col("nb") - nwin + lead_half)
    h = h.withColumn("got", F.when(whole & (F.count("m").over(w) >= need), stat))
    h = trim_halo(h, "b", max(axis_block // block, 4 * nwin))
    # a record shorter than one window takes one statistic for all of it
    one = blk.where(F.col("nb") < nwin).groupBy(*keys).agg(
        (F.avg("m") if smooth else F.median("m")).alias("_one"), F.count("m").alias("_c"))
    h = h.join(one.where(F.col("_c") >= need).drop("_c"), keys, "left")
    h = cut_lineage(h.withColumn("got", F.when(F.col("nb") < nwin, F.col("_one")).otherwise(F.col("got"))))
    # each block with the finite blocks before and after it
    f = neighbours(h.select(*keys, "b", "got", "t0"), keys, "b", "got", max(axis_block // block, 4), strict=True)
    s = d.select(*keys, "i", "b").join(f, [*keys, "b"])
    at = F.col("i") - F.col("t0")
    centre = lambda c: F.col(c) * block + 0.5 * (block - 1)
    here = F.col("got").isNotNull()
    early = at < centre("b")
    p_pos, p_val = F.when(here & ~early, F.col("b")).otherwise(F.col("prev_pos")), F.when(here & ~early, F.col("got")).otherwise(F.col("prev_val"))
    n_pos, n_val = F.when(here & early, F.col("b")).otherwise(F.col("next_pos")), F.when(here & early, F.col("got")).otherwise(F.col("next_val"))
    s = s.withColumns({"_pp": p_pos, "_pv": p_val, "_np": n_pos, "_nv": n_val})
    line = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (at - centre("_pp")) / ((F.col("_np") - F.col("_pp")) * block)
    off = F.when(F.col("_pv").isNull(), F.col("_nv")).when(F.col("_nv").isNull(), F.col("_pv")).otherwise(line)
    return s.select(*keys, "i", off.alias("off"))


def level_match(members: DataFrame, axis: DataFrame, block: int = LEVEL_BLOCK, nwin: int = LEVEL_WINDOW,
                min_frac: float = LEVEL_MIN_FRAC, min_members: int = LEVEL_MIN_MEMBERS, passes: int = 2,
                axis_block: int = AXIS_BLOCK) -> DataFrame:
    """Members set on the fleet's own level: (target, member, i, x, off), x less its slow offset and the common base.

    `axis` is (target, t0, n). With two passes the first takes the running mean of the blocks and the second the
    running median; the base is the mean of the first fleet level. A member the fleet never overlaps falls back
    to its own mean.
    """
    x = cut_lineage(members.select(*TM, "i", "x")).withColumn("off", F.lit(0.0))
    axis, base = cut_lineage(axis), None
    for p in range(max(1, passes)):
        lv = fleet_level(x, min_members)
        if base is None:
            base = cut_lineage(lv.groupBy("target").agg(F.coalesce(F.avg("level"), F.lit(0.0)).alias("base")))
        r = x.join(lv, ["target", "i"], "left").withColumn("r", F.col("x") - F.col("level"))
        o = _offset(r.select(*TM, "i", "r"), TM, passes > 1 and p == 0, axis, block, nwin, min_frac, axis_block).withColumnRenamed("off", "_o")
        lone = x.groupBy(*TM).agg(F.avg("x").alias("_mean")).join(base, "target").select(*TM, F.coalesce(F.col("_mean") - F.col("base"), F.lit(0.0)).alias("_alone"))
        x = cut_lineage(x.join(o, [*TM, "i"], "left").join(lone, TM).withColumn("_o", F.coalesce("_o", "_alone"))
                        .select(*TM, "i", (F.col("x") - F.col("_o")).alias("x"), (F.col("off") + F.col("_o")).alias("off")))
    return x.join(base, "target").select(*TM, "i", (F.col("x") - F.col("base")).alias("x"), "off")


def one_sided_offset(x: DataFrame, level: DataFrame, axis: DataFrame, block: int = LEVEL_BLOCK, nwin: int = LEVEL_WINDOW,
                     min_frac: float = LEVEL_MIN_FRAC, passes: int = 2, axis_block: int = AXIS_BLOCK) -> DataFrame:
    """The offset of one record from a level that is already established and that it does not enter."""
    d = x.select("target", "i", "x").withColumn("off", F.lit(0.0))
    for p in range(max(1, passes)):
        r = d.join(level, ["target", "i"], "left").withColumn("r", F.col("x") - F.col("level"))
        o = _offset(r.select("target", "i", "r"), ["target"], passes > 1 and p == 0, axis, block, nwin, min_frac, axis_block).withColumnRenamed("off", "_o")
        d = d.join(o, ["target", "i"], "left").withColumn("_o", F.coalesce("_o", F.lit(0.0))).select(
            "target", "i", (F.col("x") - F.col("_o")).alias("x"), (F.col("off") + F.col("_o")).alias("off"))
    return d


def stack(members: DataFrame, weights: DataFrame, min_members: int = STACK_MIN, others: DataFrame | None = None) -> DataFrame:
    """Weighted mean of the sound members at each sample: zero and not covered where fewer than the floor are sound.

    `others` (target, i, x, weight) enters the mean and is not counted for the floor: an observatory. Partial
    sums merge before the shuffle.
    """
    m = members.join(weights.select(*TM, "weight"), TM).where(F.col("x").isNotNull()).select(
        "target", "i", (F.col("weight") * F.col("x")).alias("num"), F.col("weight").alias("den"), F.lit(1).alias("one"))
    if others is not None:
        m = m.unionByName(others.where(F.col("x").isNotNull()).select(
            "target", "i", (F.col("weight") * F.col("x")).alias("num"), F.col("weight").alias("den"), F.lit(0).alias("one")))
    g = m.groupBy("target", "i").agg(F.sum("num").alias("_n"), F.sum("den").alias("_d"), F.sum("one").alias("n_members"))
    ok = (F.col("_d") > 0) & (F.col("n_members") >= min_members)
    return g.select("target", "i", F.when(ok, F.col("_n") / F.col("_d")).otherwise(F.lit(0.0)).alias("x"), ok.alias("mask"), "n_members")


def count_profile(stacked: DataFrame, axis: DataFrame, n_members: DataFrame, floor: int = STACK_MIN) -> DataFrame:
    """How ragged the member coverage is: fewest, zero, under half, full, and what the floor costs.

    Positions no member reaches count as zero, from the length of the axis and not from rows.
    """
    c = F.col("n_members")
    # n_members is at most STACK_MAX, so the profile is a handful of counts per target
    h = stacked.groupBy("target", "n_members").agg(F.count(F.lit(1)).alias("_c"))
    j = h.join(n_members.withColumnRenamed("n_members", "_all"), "target").join(axis.select("target", "n"), "target")
    share = lambda cond, z: (F.sum(F.when(cond, F.col("_c")).otherwise(0)) + z) / F.max("n")
    miss = F.max("n") - F.sum("_c")
    half = F.greatest(F.lit(1), F.floor(F.col("_all") / 2))
    return j.groupBy("target").agg(
        F.when(miss > 0, F.lit(0)).otherwise(F.min(c)).alias("fewest"), share(c == 0, miss).alias("frac_zero"),
        share(c < half, miss).alias("frac_lt_half"), share(c == F.col("_all"), F.lit(0)).alias("frac_full"),
        (F.sum(F.when(c < floor, F.col("_c")).otherwise(0)) + miss).alias("samples_below"))


# ---------------------------------------------------------------- who is a member, who is the remote

def overlap_floor(own_days: Column, usable_days: Column, min_days: float = MIN_OVERLAP_DAYS) -> Column:
    u = F.when(usable_days > 0, usable_days).otherwise(own_days)
    return F.least(F.lit(min_days), F.lit(0.75) * F.least(u, own_days))


def candidate_table(pairs: DataFrame) -> DataFrame:
    """Each (target, name) with whether it clears the overlap floor and the reason where it does not.

    `pairs` carries overlap_days, own_days, usable_days, coh; the coherence of a pair under the floor is not read.
    """
    fl = overlap_floor(F.col("own_days"), F.col("usable_days"))
    ok = F.coalesce(F.col("overlap_days") >= fl, F.lit(False))
    return pairs.withColumns({"floor_days": fl, "ok": ok, "overlap_frac": F.col("overlap_days") / F.col("own_days"),
                              "coh": F.when(ok, F.col("coh")),
                              "why": F.when(F.coalesce(F.col("overlap_days"), F.lit(0.0)) <= 0, "no overlap")
                              .when(~ok, "overlap under the floor").otherwise("")})


def remote_choice(cands: DataFrame, coh_min: float = COH_MIN, coh_relax: float = COH_RELAX) -> DataFrame:
    """The five-branch rule: one remote per target with the branch that chose it.

    Branch 1 clean, coherent, at least 90 % overlap: nearest. 2 clean and coherent: longest overlap. 3 clean with
    the gate relaxed: most coherent. 4 coherent: fewest events. 5 nearest, over the candidates that cleared the
    floor or, where none did, over all. Every candidate is given the lowest branch it qualifies for and one
    aggregate keeps the best.
    """
    clean, coh = F.coalesce("clean", F.lit(False)), F.coalesce(F.col("coh"), F.lit(-1.0))
    b = (F.when(~F.col("ok"), 6).when(clean & (coh >= coh_min) & (F.col("overlap_frac") >= 0.9), 1)
         .when(clean & (coh >= coh_min), 2).when(clean & (coh >= coh_relax), 3).when(coh >= coh_min, 4).otherwise(5))
    key = (F.when(b == 2, -F.col("overlap_days")).when(b == 3, -coh)
           .when(b == 4, F.coalesce("event_frac", F.lit(1.0))).otherwise(F.col("km")))
    best = F.min(F.struct(b.alias("branch"), key.alias("key"), F.col("km").alias("km"), F.col("name").alias("name"), F.col("coh").alias("coh")))
    return cands.groupBy("target").agg(best.alias("_b"), F.count(F.lit(1)).alias("n_considered"), F.count_if(~F.col("ok")).alias("n_short")).select(
        "target", F.col("_b.name").alias("name"), F.least(F.col("_b.branch"), F.lit(5)).alias("branch"),
        F.when(F.col("_b.branch") <= 5, F.col("_b.coh")).alias("coh"), "n_considered", "n_short")


def with_named_remote(rule: DataFrame, decisions: DataFrame) -> DataFrame:
    """A remote the decisions table names overrides the rule, whose own pick stays beside it."""
    from ..functions import cells
    d = rule.join(decisions.select("target", cells.name(F.col("remote_site")).alias("_named")), "target", "left")
    named = F.coalesce(F.col("_named"), F.lit("")) != ""
    return d.select("target", F.when(named, F.col("_named")).otherwise(F.col("name").cast("string")).alias("remote"),
                    F.when(named, F.lit(0)).otherwise(F.col("branch")).alias("branch"), F.col("name").alias("rule_name"),
                    F.col("branch").alias("rule_branch"), F.when(named, "decisions").otherwise("rule").alias("source"))


def lender_refusal(cands: DataFrame, decisions: DataFrame) -> DataFrame:
    """Candidates with the reason the lender rule keeps them out of a target's reference, '' where it does not.

    A station with a borrowed field is never a member; a station lending to the target is never one of its own.
    """
    d = decisions.select(F.col("site").alias("_s"), "lender")
    own, tgt = d.withColumnRenamed("lender", "_cl"), d.withColumnRenamed("lender", "_tl")
    j = cands.join(own, F.col("name") == F.col("_s"), "left").drop("_s").join(tgt, F.col("target") == F.col("_s"), "left").drop("_s")
    return j.withColumn("refused", F.when(F.col("_cl").isNotNull(), "its field is borrowed")
                        .when(F.col("name") == F.col("_tl"), "it lends to the target").otherwise("")).drop("_cl", "_tl")


def stack_members(cands: DataFrame, weights: DataFrame, cutoff: float = STACK_CUTOFF, n_max: int = STACK_MAX) -> DataFrame:
    """Every candidate as a member with its weight or refused with the reason; the best `n_max` weights stay."""
    d = cands.join(weights.select(F.col("site").alias("name"), "weight"), "name", "left")
    out = d.withColumn("note", F.when(F.col("refused") != "", F.col("refused")).when(~F.col("ok"), F.col("why"))
                       .when(F.col("weight").isNull() | (F.col("weight") <= 0), "no fleet coherence")
                       .when(F.col("weight") < cutoff, "fleet coherence under the cutoff"))
    w = Window.partitionBy("target", F.col("note").isNull()).orderBy(F.desc("weight"), F.desc("name"))
    out = out.withColumn("_r", F.row_number().over(w))
    note = F.when(F.col("note").isNull() & (F.col("_r") > n_max), f"outside the best {n_max}").otherwise(F.col("note"))
    return out.select("target", "name", F.when(note.isNull(), F.col("weight")).alias("weight"),
                      F.when(note.isNull(), "member").otherwise("refused").alias("role"), F.coalesce(note, F.lit("")).alias("note"))
