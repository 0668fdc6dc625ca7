"""Reference series of every target at once: remote, stack, observatory, and stack with observatory."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import intervals, reference, robust
from ..operators.axis import AXIS_BLOCK

TM = ["target", "member"]


def aligned_members(members: DataFrame, events: DataFrame | None, lags: DataFrame | None, edge: int, block: int = AXIS_BLOCK) -> DataFrame:
    """Members on the target's axis without their own events, screened inside every run end, then shifted.

    The order is fixed: the screen has to run before the shift, which would spread what the screen removes.
    `events` is (member, t_start, t_end); `lags` is (target, member, lag) in samples.
    """
    d = members
    if events is not None:
        d = intervals.mark(d, events, ["member"], "i", "t_start", "t_end", "_ev").withColumn("x", F.when(~F.col("_ev"), F.col("x"))).drop("_ev")
    d = robust.screen_edges(d, TM, "i", "x", edge, block)
    if lags is not None:
        d = d.join(lags, TM, "left")
        d = robust.shift(d, TM, "i", "x", F.coalesce("lag", F.lit(0.0)), block).drop("lag")
        d = members.select(*TM, "i").join(d.select(*TM, "i", "x"), [*TM, "i"], "left")
    return d


def build_stack(members: DataFrame, axis: DataFrame, weights: DataFrame, events: DataFrame | None = None, lags: DataFrame | None = None,
                edge: int = 120, observatory: DataFrame | None = None, min_members: int = reference.STACK_MIN, screen_k: float = reference.SCREEN_K,
                level: dict | None = None, block: int = AXIS_BLOCK) -> DataFrame:
    """(target, i, x, mask, n_members): members aligned, spike-screened against each other, levelled and averaged.

    With `observatory` (target, i, x, weight) it enters on the members' level, which it does not take part in.
    """
    level = level or {}
    d = aligned_members(members, events, lags, edge, block)
    d = reference.member_screen(d, k=screen_k, block=block).select(*TM, "i", "x")
    d = reference.level_match(d, axis, axis_block=block, **level)
    extra = None
    if observatory is not None:
        lv = reference.fleet_level(d)
        o = reference.one_sided_offset(observatory, lv, axis, axis_block=block, **level)
        extra = o.select("target", "i", "x").join(observatory.select("target", "i", "weight"), ["target", "i"])
    return reference.stack(d, weights, min_members, extra)


def build_remote(members: DataFrame, choice: DataFrame) -> DataFrame:
    """The chosen remote's pair on the target's axis: zero and not covered outside its own record, events left in."""
    d = members.join(choice.select("target", F.col("name").alias("member")), TM, "left_semi")
    return d.select("target", "i", F.coalesce("x", F.lit(0.0)).alias("x"), F.col("x").isNotNull().alias("mask"))
