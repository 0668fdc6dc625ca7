"""The lender job: every station's record with its decisions applied, borrowed magnetic channels taken from a decided, turned and aligned lender.

Two generations are made. The lenders come first: their own decisions, without what they borrow themselves, then their mean-field frame. What a
station borrows is then the decided record of its lender on the station's own positions, advanced by the lag that it has behind the station.

Defined results: a lender of a lender is not followed; a lag that a gate refuses counts as 0 and its note says why; a lender without a record lends
NULL; positions that the lender lacks are NULL in the borrowed channels; a station that names itself borrows nothing.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import decisions, lags, robust
from ..operators.axis import AXIS_BLOCK
from ..session import cut_lineage

H = ("hx", "hy", "hz")


def borrowings(values: DataFrame, key: str) -> DataFrame:
    """(key, lender, lender_channels) of the stations that name another station."""
    return values.where((F.col("lender") != "") & (F.col("lender") != F.col(key).cast("string"))).select(key, "lender", "lender_channels")


def lent(samples: DataFrame, values: DataFrame, key: str, pos: str, fs: float = 1.0, regimes: DataFrame | None = None, drop: DataFrame | None = None,
         block: int = AXIS_BLOCK) -> DataFrame:
    """(key, pos, hx, hy, hz): the decided lender's record in its mean-field frame, once for every station that borrows it, before any shift.

    `regimes` and `drop` are the lenders' position ranges, as for `rotate_to_mean_field`. Only samples of lenders are worked on.
    """
    b = borrowings(values, key).select(F.col(key).alias("_to"), F.col("lender").alias("_from"))
    of = F.col(key).cast("string")
    lenders = b.select("_from").distinct()
    own = samples.join(lenders, of == F.col("_from"), "left_semi")
    theirs = values.join(lenders, of == F.col("_from"), "left_semi").withColumn("lender", F.lit(""))
    turned = decisions.rotate_to_mean_field(decisions.apply_decisions(own, theirs, key, pos, fs, block=block), [key], pos, regimes, drop)
    return turned.select(of.alias("_from"), pos, *H).join(b, "_from").select(F.col("_to").alias(key), pos, *H)


def lender_lags(samples: DataFrame, lent_samples: DataFrame, values: DataFrame, key: str, pos: str, fs: float = 1.0, **how) -> DataFrame:
    """(key, lender, lag_s, spread, n_windows, note): how far each lender is behind the station's own horizontal field, 0 where a gate refuses.

    The station's field is the one recorded, before its decisions. `how` goes to `lags.member_lags`.
    """
    b = borrowings(values, key)
    mine, theirs = F.concat(F.lit("own "), F.col(key).cast("string")), F.concat(F.lit("lent "), F.col(key).cast("string"))
    pairs = b.select(key, "lender", mine.alias("a"), theirs.alias("b"))
    own = samples.join(b.select(key), key, "left_semi").select(mine.alias("_site"), pos, "hx", "hy")
    both = own.unionByName(lent_samples.select(theirs.alias("_site"), pos, "hx", "hy"))
    found = lags.member_lags(both, pairs, "_site", pos, fs=fs, **how)
    return pairs.join(found, ["a", "b"]).select(key, "lender", "lag_s", "spread", "n_windows", "note")


def aligned(lent_samples: DataFrame, lag: DataFrame, key: str, pos: str, fs: float = 1.0, block: int = AXIS_BLOCK) -> DataFrame:
    """(key, pos, l_hx, l_hy, l_hz): the lent samples with the lag of `lag` (key, lag_s) taken out; records without a lag pass untouched."""
    d = lent_samples.join(lag.select(key, (F.col("lag_s") * fs).alias("_delay")), key, "left")
    moved = F.coalesce(F.col("_delay") != 0, F.lit(False))
    still = d.where(~moved).select(key, pos, *[F.col(h).alias("l_" + h) for h in H])
    # the three channels go through one shift, as records of their own
    go = d.where(moved).select(key, pos, "_delay", F.explode(F.array(*[F.struct(F.lit(h).alias("_chan"), F.col(h).alias("_v")) for h in H])).alias("c"))
    go = robust.shift(go.select(key, pos, "_delay", "c.*"), [key, "_chan"], pos, "_v", F.col("_delay"), block)
    go = go.groupBy(key, pos).agg(*[F.max(F.when(F.col("_chan") == h, F.col("_v"))).alias("l_" + h) for h in H])
    return still.unionByName(go)


def decided(samples: DataFrame, values: DataFrame, key: str, pos: str, fs: float = 1.0, with_lender: bool = True, regimes: DataFrame | None = None,
            drop: DataFrame | None = None, lag: DataFrame | None = None, block: int = AXIS_BLOCK, **how) -> tuple[DataFrame, DataFrame | None]:
    """The five channels of every station with all decisions applied, and the lags that were taken out of the lenders.

    `values` is `decision_values`; `lag` (key, lag_s) states the lags instead of measuring them. Without `with_lender` every station keeps its own
    channels, as members and remotes of a reference need them, and no lags are returned.
    """
    own = values.withColumn("lender", F.when(F.col("lender") == F.col(key).cast("string"), "").otherwise(F.col("lender")))
    if not with_lender:
        return decisions.apply_decisions(samples, own.withColumn("lender", F.lit("")), key, pos, fs, block=block), None
    # read for the lags of each band and for the record: the decisions of the lenders are worked out once
    theirs = cut_lineage(lent(samples, own, key, pos, fs, regimes, drop, block))
    if lag is None:
        lag = lender_lags(samples, theirs, own, key, pos, fs, **how)
    return decisions.apply_decisions(samples, own, key, pos, fs, aligned(theirs, lag, key, pos, fs, block), block), lag
