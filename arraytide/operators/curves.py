"""Response curves in long form (curve keys, period, comp, re, im, err).

A curve has some tens of periods, so windows over one curve are bounded; it is the number of curves that grows.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars

# fixed values
AGREE_RHO = 0.20
AGREE_PHASE = 5.0
AGREE_BAND = (5.0, 200.0)
QUALITY_BAND = (10.0, 1000.0)
DECADES = ((5.0, 10.0), (10.0, 100.0), (100.0, 1000.0), (1000.0, 10000.0))
GAP_DEX = 0.30
NEAREST_PCT = 1.0


def mask(tf: DataFrame) -> DataFrame:
    """Each component masked on its own: fills, no-information errors and zeros without a bar become NULL."""
    bad = scalars.is_masked(F.col("re"), F.col("im"), F.col("err"))
    err = F.when(F.col("err").isNotNull() & ~F.isnan("err") & (F.abs("err") < scalars.FILL), F.col("err"))
    return tf.withColumns({"_bad": bad}).withColumns({
        "re": F.when(~F.col("_bad"), F.col("re")), "im": F.when(~F.col("_bad"), F.col("im")),
        "err": F.when(~F.col("_bad"), err)}).drop("_bad")


def unique_periods(tf: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per (keys, comp, period), the first in source order."""
    rest = [c for c in tf.columns if c not in (*keys, "comp", "period")]
    g = tf.groupBy(*keys, "comp", "period").agg(F.min_by(F.struct(*rest), F.col(order)).alias("_f"))
    return g.select(*keys, "comp", "period", "_f.*")


def align_nearest(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str], pct: float = NEAREST_PCT) -> DataFrame:
    """The source value at the nearest period within `pct` per cent of each target period, never interpolated.

    An equi-join on a logarithmic bucket as wide as the tolerance and its two neighbours, then one aggregate.
    """
    w = math.log1p(pct / 100.0)
    b = lambda p: F.floor(F.log(p) / w).cast("bigint")
    t = target.withColumn("_b", F.explode(F.array(b("period") - 1, b("period"), b("period") + 1)))
    s = source.select(*keys, b("period").alias("_b"), F.col("period").alias("src_period"), *[F.col(c).alias("src_" + c) for c in cols])
    j = t.join(s, [*keys, "_b"])
    d = F.abs(F.log("period") - F.log("src_period"))
    near = (j.where(d < w).groupBy(*keys, "period")
            .agg(F.min_by(F.struct("src_period", *["src_" + c for c in cols]), F.struct(d, "src_period")).alias("_n")))
    return target.join(near.select(*keys, "period", "_n.*"), [*keys, "period"], "left")


def unwrap(df: DataFrame, keys: list[str], order: str, angle: str, out: str) -> DataFrame:
    """The angle in radians made continuous along `order`."""
    w = Window.partitionBy(*keys).orderBy(order)
    d = F.col(angle) - F.lag(angle).over(w)
    m = F.pmod(d + math.pi, F.lit(2 * math.pi)) - math.pi
    m = F.when((m == -math.pi) & (d > 0), F.lit(math.pi)).otherwise(m)
    step = F.when(F.abs(d) >= math.pi, m - d).otherwise(F.lit(0.0))
    d1 = df.withColumn("_st", F.coalesce(step, F.lit(0.0)))
    return d1.withColumn(out, F.col(angle) + F.sum("_st").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_st")


def interpolate(nodes: DataFrame, queries: DataFrame, keys: list[str], x: str, cols: list[str], outside: str = "missing",
                max_gap: float | None = None) -> DataFrame:
    """`queries` with `cols` linear in `x` between the nodes of their key.

    `outside` is 'missing' or 'clamp'; a hole between two nodes wider than `max_gap` is not bridged. Nodes and
    queries of a key meet in one ordered window over both, a bounded group.
    """
    tag = F.struct(F.col(x).alias("x"), *[F.col(c).alias(c) for c in cols])
    n = nodes.select(*keys, F.col(x).alias("_x"), tag.alias("_node"), F.lit(None).cast(queries.select(F.struct("*")).schema[0].dataType).alias("_q"))
    q = queries.select(*keys, F.col(x).alias("_x"), F.lit(None).cast(n.schema["_node"].dataType).alias("_node"), F.struct("*").alias("_q"))
    # nodes sort before a query at the same x, so the node at the query itself is its left neighbour
    w = Window.partitionBy(*keys).orderBy("_x", F.col("_q").isNotNull())
    u = n.unionByName(q)
    u = u.withColumn("_l", F.last("_node", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    u = u.withColumn("_r", F.first("_node", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    u = u.where(F.col("_q").isNotNull())
    exact = F.col("_l.x") == F.col("_x")
    gap = F.col("_r.x") - F.col("_l.x")
    ok = F.lit(True) if max_gap is None else (gap <= max_gap) | (exact & F.col("_r.x").isNull())
    out = []
    for c in cols:
        a, b = F.col(f"_l.{c}"), F.col(f"_r.{c}")
        line = a + (b - a) * (F.col("_x") - F.col("_l.x")) / gap
        v = F.when(exact, a).when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), line)
        if outside == "clamp":
            v = F.coalesce(v, a, b)
        out.append(F.when(ok, v).alias("i_" + c) if max_gap is not None else v.alias("i_" + c))
    return u.select("_q.*", *out)


def on_periods(tf: DataFrame, targets: DataFrame, keys: list[str], max_gap: float = GAP_DEX) -> DataFrame:
    """A curve on other periods: linear in log period of log |Z| and the unwrapped phase, errors in log.

    No extrapolation and no bridging of a hole wider than `max_gap` decades. `targets` is (keys, comp, period).
    """
    kc = [*keys, "comp"]
    m = scalars.magnitude(F.col("re"), F.col("im"))
    n = tf.where(m > 0).withColumns({"lx": F.log10("period"), "mag": F.log10(m), "ang": F.atan2("im", "re"),
                                     "lerr": F.when(F.col("err") > 0, F.log10("err"))})
    n = unwrap(n, kc, "lx", "ang", "ph")
    got = interpolate(n, targets.withColumn("lx", F.log10("period")), kc, "lx", ["mag", "ph", "lerr"], max_gap=max_gap)
    r = F.pow(F.lit(10.0), F.col("i_mag"))
    return got.select(*targets.columns, (r * F.cos("i_ph")).alias("re"), (r * F.sin("i_ph")).alias("im"),
                      F.pow(F.lit(10.0), F.col("i_lerr")).alias("err"))


def tipper_on_periods(tf: DataFrame, targets: DataFrame, keys: list[str], max_gap: float | None = GAP_DEX) -> DataFrame:
    """Real and imaginary parts linear in log period: a tipper part changes sign, a logarithm cannot carry it."""
    kc = [*keys, "comp"]
    got = interpolate(tf.withColumn("lx", F.log10("period")), targets.withColumn("lx", F.log10("period")), kc, "lx",
                      ["re", "im", "err"], max_gap=max_gap)
    return got.select(*targets.columns, *[F.col("i_" + c).alias(c) for c in ("re", "im", "err")])


def pair_list(tf: DataFrame, within: list[str], name: str, ordered: bool = True) -> DataFrame:
    """(within, a, b): the pairs of curves of one station, component and whatever else `within` holds together.

    A station has a handful of curves; pairs are made between curve names, never between their points.
    """
    c = tf.select(*within, name).distinct()
    a, b = c.withColumnRenamed(name, "a"), c.withColumnRenamed(name, "b")
    return a.join(b, within).where(F.col("a") < F.col("b") if ordered else F.col("a") != F.col("b"))


def paired(tf: DataFrame, pairs: DataFrame, within: list[str], name: str, outside: str = "clamp", lo: float = 0.0,
           hi: float = float("inf")) -> DataFrame:
    """Points of curve a inside [lo, hi] with b's log rho and phase interpolated there in log period.

    Columns: within, a, b, period, ratio (b over a), dphi (b less a, wrapped), n_b (usable points of b).
    """
    s = scalars.with_scalars(tf).where((F.col("rho") > 0) & F.col("phase").isNotNull()).select(
        *within, F.col(name).alias("_nm"), "period", F.log("period").alias("lx"), F.log("rho").alias("lr"), F.col("phase").alias("ph"))
    pk = [*within, "a", "b"]
    q = pairs.join(s.withColumnRenamed("_nm", "a").where((F.col("period") >= lo) & (F.col("period") <= hi)), [*within, "a"]).select(
        *pk, "period", "lx", F.col("lr").alias("lra"), F.col("ph").alias("pha"))
    n = pairs.join(s.withColumnRenamed("_nm", "b"), [*within, "b"]).select(*pk, "lx", "lr", "ph")
    n = n.withColumn("nb", F.count(F.lit(1)).over(Window.partitionBy(*pk)))
    got = interpolate(n, q, pk, "lx", ["lr", "ph", "nb"], outside)
    return got.select(*pk, "period", F.exp(F.col("i_lr") - F.col("lra")).alias("ratio"),
                      scalars.wrap180(F.col("i_ph") - F.col("pha")).alias("dphi"), F.col("i_nb").alias("n_b"))


def agreement(points: DataFrame, keys: list[str], rho_tol: float = AGREE_RHO, phase_tol: float = AGREE_PHASE) -> DataFrame:
    """The median departures of one curve from another and whether they agree: both tolerances, two points each."""
    g = points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max("n_b").alias("_nb"), F.median(F.abs(F.col("ratio") - 1)).alias("rho_dev"),
        F.median(F.abs("dphi")).alias("phase_dev_deg"), F.median("ratio").alias("rho_ratio"), F.median("dphi").alias("phase_diff_deg"))
    enough = (F.col("n") >= 2) & (F.col("_nb") >= 2)
    stats = ["rho_dev", "phase_dev_deg", "rho_ratio", "phase_diff_deg"]
    return g.select(*keys, "n", *[F.when(enough, F.col(c)).alias(c) for c in stats],
                    F.coalesce(enough & (F.round("rho_dev", 12) <= rho_tol) & (F.round("phase_dev_deg", 12) <= phase_tol), F.lit(False)).alias("agrees"))


def band_stats(points: DataFrame, keys: list[str], bands, min_points: int = 4, closed: bool = False) -> DataFrame:
    """Median ratio, its quartile spread, median phase difference and count per band, [lo, hi) unless `closed`."""
    arr = F.array(*[F.struct(F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for a, b in bands])
    upper = (F.col("period") <= F.col("b_.hi")) if closed else (F.col("period") < F.col("b_.hi"))
    d = points.withColumn("b_", F.explode(arr)).where((F.col("period") >= F.col("b_.lo")) & upper)
    g = d.groupBy(*keys, F.col("b_.lo").alias("lo"), F.col("b_.hi").alias("hi")).agg(
        F.count("ratio").alias("n"), F.median("ratio").alias("rho_ratio"), F.median("dphi").alias("phase_diff_deg"),
        F.percentile("ratio", 0.75).alias("_q3"), F.percentile("ratio", 0.25).alias("_q1"))
    ok = F.col("n") >= min_points
    return g.select(*keys, "lo", "hi", "n", F.when(ok, F.col("rho_ratio")).alias("rho_ratio"),
                    F.when(ok, F.col("_q3") / F.greatest("_q1", F.lit(1e-30))).alias("spread"),
                    F.when(ok, F.col("phase_diff_deg")).alias("phase_diff_deg"))


def bar(tf: DataFrame, keys: list[str], lo: float, hi: float, out: str = "bar") -> DataFrame:
    """The median relative impedance error over a closed band."""
    s = scalars.with_scalars(tf).where((F.col("period") >= lo) & (F.col("period") <= hi) & F.col("rel").isNotNull())
    return s.groupBy(*keys).agg(F.median("rel").alias(out))


def local_z(tf: DataFrame, keys: list[str], x: str, y: str, sigma: str, half: int = 3, min_points: int = 4, out: str = "z") -> DataFrame:
    """Residual of each point from the weighted quadratic through its neighbours, over the combined sigma.

    The point is left out of its own fit. The normal equations are 3 x 3 and solved in closed form on the frame.
    """
    w = Window.partitionBy(*keys).orderBy(x)
    good = F.col(y).isNotNull() & (F.col(sigma) > 0)
    d = tf.withColumn("_near", F.collect_list(F.when(good, F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col(sigma).alias("s")))).over(w.rowsBetween(-half, half)))
    near = F.filter("_near", lambda p: p["x"] != F.col(x))
    d = d.withColumn("_near", near)

    def total(f):
        return F.aggregate("_near", F.lit(0.0), lambda a, p: a + f(p["x"] - F.col(x), p["y"], 1.0 / (p["s"] * p["s"])))
    cols = {f"_s{k}": total(lambda u, v, g, k=k: g * F.pow(u, F.lit(float(k)))) for k in range(5)}
    cols.update({f"_t{k}": total(lambda u, v, g, k=k: g * v * F.pow(u, F.lit(float(k)))) for k in range(3)})
    d = d.withColumns(cols)
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("_s0", "_s1", "_s2", "_s3", "_s4", "_t0", "_t1", "_t2"))
    c00, c01, c02 = s2 * s4 - s3 * s3, s2 * s3 - s1 * s4, s1 * s3 - s2 * s2
    det = s0 * c00 + s1 * c01 + s2 * c02
    fit, var = (c00 * t0 + c01 * t1 + c02 * t2) / det, c00 / det
    z = (F.col(y) - fit) / F.sqrt(F.col(sigma) * F.col(sigma) + F.greatest(var, F.lit(0.0)))
    return d.withColumn(out, F.when(good & (F.size("_near") >= min_points) & (det != 0), z)).drop("_near", *cols)


def smoothness(tf: DataFrame, keys: list[str], jump_z: float = 4.0) -> DataFrame:
    """Jumps off the local trend, the largest phase step per decade and the rho-phase residual of each curve."""
    s = scalars.with_scalars(tf).where((F.col("rho") > 0) & F.col("phase").isNotNull())
    s = s.withColumns({"lt": F.log10("period"), "lr": F.log10("rho"), "slr": F.col("rho_err") / F.col("rho") / math.log(10)})
    s = local_z(local_z(s, keys, "lt", "lr", "slr", out="z_r"), keys, "lt", "phase", "phase_err", out="z_p")
    w = Window.partitionBy(*keys).orderBy("lt")
    dph = F.abs(scalars.wrap180(F.col("phase") - F.lag("phase").over(w)))
    hl, hr = F.col("lt") - F.lag("lt").over(w), F.lead("lt").over(w) - F.col("lt")
    fl, fr = F.col("lr") - F.lag("lr").over(w), F.lead("lr").over(w) - F.col("lr")
    grad = (F.when(hl.isNull(), fr / hr).when(hr.isNull(), fl / hl)
            .otherwise((hl * hl * fr + hr * hr * fl) / (hl * hr * (hl + hr))))
    s = s.withColumns({"worst": F.greatest(F.abs("z_r"), F.abs("z_p")), "dph": dph, "rate": dph / F.greatest(hl, F.lit(0.05)),
                       "res": F.abs(F.col("phase") - 45.0 * (1.0 - grad))})
    g = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_periods"), F.count_if(F.col("worst") > jump_z).alias("n_jumps"), F.max("worst").alias("worst_z"),
                             F.max("dph").alias("max_phase_step_deg"), F.max("rate").alias("max_phase_step_deg_per_decade"),
                             F.median("res").alias("median_abs_dphi_deg"), (F.max("lt") - F.min("lt")).alias("_dec"))
    ok = F.col("n_periods") >= 5
    return g.select(*keys, "n_periods", F.when(ok, F.col("n_jumps")).otherwise(F.lit(0)).alias("n_jumps"),
                    F.when(ok, F.col("n_jumps") / F.greatest("_dec", F.lit(1e-9))).alias("jumps_per_decade"),
                    *[F.when(ok, F.col(c)).alias(c) for c in ("worst_z", "max_phase_step_deg", "max_phase_step_deg_per_decade", "median_abs_dphi_deg")])


def quadrant_sign(tf: DataFrame, keys: list[str], lo: float = 30.0, hi: float = 1000.0, n: int = 6, min_in: int = 4) -> DataFrame:
    """+1 where most of n spread periods lie in 0..90 deg, -1 in -180..-90, NULL where neither does."""
    s = scalars.with_scalars(tf).where((F.col("period") >= lo) & (F.col("period") <= hi) & F.col("phase").isNotNull())
    w = Window.partitionBy(*keys)
    s = s.withColumns({"_k": F.row_number().over(w.orderBy("period")) - 1, "_n": F.count(F.lit(1)).over(w)})
    picks = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.bround(j * (F.col("_n") - 1) / F.lit(float(n - 1)), 0).cast("int"))
    s = s.withColumn("_in", F.array_contains(picks, F.col("_k")))
    p = F.col("phase")
    g = s.groupBy(*keys).agg(F.max("_n").alias("n_band"), F.count_if(F.col("_in") & p.between(0, 90)).alias("first"),
                             F.count_if(F.col("_in") & p.between(-180, -90)).alias("third"))
    enough = F.col("n_band") >= n
    return g.withColumn("sign", F.when(enough & (F.col("first") >= min_in), 1).when(enough & (F.col("third") >= min_in), -1))


def trim(tf: DataFrame, keys: list[str], bands: DataFrame) -> DataFrame:
    """Each row component inside its own band; a period with neither off-diagonal left is dropped.

    `bands` is (keys, comp, lo, hi). A set of bands that would empty the curve is not applied and `applied` says so.
    """
    d = tf.join(bands, [*keys, "comp"], "left")
    inside = F.coalesce((F.col("period") >= F.col("lo")) & (F.col("period") <= F.col("hi")), F.lit(True))
    off = F.col("comp").isin("xy", "yx")
    d = d.withColumn("_live", inside & off & F.col("re").isNotNull())
    d = d.withColumn("_any", F.max("_live").over(Window.partitionBy(*keys)))
    d = d.withColumn("_row", F.max("_live").over(Window.partitionBy(*keys, "period")))
    return d.where(~F.col("_any") | (inside & F.col("_row"))).select(*tf.columns, F.col("_any").alias("applied"))


def merge_rows(base: DataFrame, x_from: DataFrame, y_from: DataFrame, keys: list[str]) -> DataFrame:
    """xx and xy from one source, yx and yy from the other: on the long table a merge is a union."""
    a = x_from.where(F.col("comp").isin("xx", "xy"))
    b = y_from.where(F.col("comp").isin("yx", "yy"))
    rest = base.where(~F.col("comp").isin("xx", "xy", "yx", "yy"))
    return a.unionByName(b).unionByName(rest)


def splice_period(points: DataFrame, keys: list[str], rho_tol: float = 0.05, phase_tol: float = 5.0, lo: float = 10.0, hi: float = 3000.0,
                  apart: Column | None = None, combined: Column | None = None, sigmas: float = 2.0) -> DataFrame:
    """The shortest period from which two curves agree and keep agreeing up to `hi`.

    The looser of two rules holds: both tolerances, or `apart` within `sigmas` times the `combined` deviation where there is one.
    """
    d = points.where((F.col("period") >= lo) & (F.col("period") <= hi))
    close = (F.abs(F.col("ratio") - 1) <= rho_tol) & (F.abs("dphi") <= phase_tol)
    if combined is not None:
        close = close | F.coalesce((combined > 0) & (F.abs(apart) <= sigmas * combined), F.lit(False))
    w = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    d = d.withColumn("_c", close).withColumn("_all", F.min("_c").over(w))
    return d.groupBy(*keys).agg(F.min(F.when(F.col("_all"), F.col("period"))).alias("t_c"), F.count(F.lit(1)).alias("n_tested"),
                                F.avg(F.col("_c").cast("double")).alias("frac_agree"))


def resample_grid() -> list[float]:
    """Ten periods a decade from 3.16 s to 50,119 s."""
    return [10.0 ** (k / 10.0) for k in range(5, 48)]
