"""Remote-reference response estimation on the long Fourier table.

Windowed transforms, band cross powers, Z = <E R*> <H R*>^-1 in closed form and a fixed number of Huber
reweightings of the segments: the published remote-reference and robust regression methods, written as joins and
sums. It does not reproduce any particular estimator's numbers.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalars
from ..session import cut_lineage
from .quantiles import group_percentiles

HUBER = 1.5


def band_edges(levels: DataFrame, window: int, fs: float, factor: int = 4) -> DataFrame:
    """Band edges in seconds from (level, i_min, i_max): harmonics of a window at the level's decimated rate."""
    rate = F.lit(float(fs)) / F.pow(F.lit(float(factor)), (F.col("level") - 1).cast("double"))
    df = rate / window
    lo, hi = (F.col("i_min") - 0.5) * df, (F.col("i_max") + 0.5) * df
    return levels.withColumns({"fs_hz": rate, "lower_s": 1 / hi, "centre_s": 2 / (lo + hi), "upper_s": 1 / lo})


def map_levels(rates: DataFrame, rate: str = "fs_hz", win_s: int = 3600, step_s: int = 1800, shortest_s: float = 2.0, longest_s: float = 20000.0,
               first_segments: int = 4, later_segments: int = 6, factor: int = 4) -> DataFrame:
    """`rates` once per level of a map, with level, segment, window_s, level_step_s, from_s and to_s.

    The first segment is the largest power of two that fits the window `first_segments` times; level k holds factor ** k of it, up to the
    first level whose segment is as long as the longest period.
    """
    fs = F.col(rate)
    base = F.pow(F.lit(2.0), F.floor(F.log2(F.lit(float(win_s)) * fs / first_segments) + 1e-9))
    last = F.greatest(F.ceil(F.log(F.lit(longest_s) * fs / base) / F.log(F.lit(float(factor))) - 1e-9), F.lit(0))
    d = rates.withColumn("level", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    size = base * F.pow(F.lit(float(factor)), F.col("level").cast("double"))
    top, seconds = F.col("level") == 0, size / fs
    return d.withColumns({
        "segment": size.cast("bigint"), "window_s": F.when(top, win_s).otherwise(F.floor(later_segments * seconds)),
        "level_step_s": F.when(top, step_s).otherwise(F.greatest(F.lit(step_s), F.floor(seconds / 2))),
        "from_s": F.when(top, shortest_s).otherwise(seconds / factor), "to_s": F.least(seconds, F.lit(longest_s))})


def _wide(fc: DataFrame, keys: list[str], chans: list[str]) -> DataFrame:
    return fc.groupBy(*keys, "seg", "f").agg(*[F.max(F.when(F.col("chan") == c, F.col(p))).alias(f"{c}_{p}") for c in chans for p in ("re", "im")])


def _z(name: str):
    return F.col(name + "_re"), F.col(name + "_im")


def solve(wide: DataFrame, keys: list[str], e: list[str], h: tuple[str, str], r: tuple[str, str], errors: bool = False) -> DataFrame:
    """One impedance row per electric channel and group from weighted cross powers.

    With `errors` every component has its standard error: the residual power per degree of freedom, n - 2 for two complex unknowns, times the
    spread that the reference's own power gives the estimate. It is read off further cross powers of the same pass; NULL for n < 3 and without a solution.
    """
    pairs = [(a, b) for a in (*e, *h) for b in r]
    if errors:
        pairs += [(x, x) for x in e] + [(x, y) for x in e for y in h] + [(h[0], h[0]), (h[1], h[1]), (h[0], h[1]), (r[0], r[0]), (r[1], r[1]), (r[0], r[1])]
    aggs = []
    for left, right in dict.fromkeys(pairs):
        re, im = scalars.cmul(_z(left), scalars.conj(_z(right)))
        aggs += [F.sum(F.col("w") * re).alias(f"S_{left}_{right}_re"), F.sum(F.col("w") * im).alias(f"S_{left}_{right}_im")]
    s = wide.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("n"), F.sum("w").alias("sw"))
    S = lambda a, b: _z(f"S_{a}_{b}")
    det = scalars.csub(scalars.cmul(S(h[0], r[0]), S(h[1], r[1])), scalars.cmul(S(h[0], r[1]), S(h[1], r[0])))
    dd = det[0] * det[0] + det[1] * det[1]
    out = []
    for x in e:
        for k, num in enumerate((scalars.csub(scalars.cmul(S(x, r[0]), S(h[1], r[1])), scalars.cmul(S(x, r[1]), S(h[1], r[0]))),
                                 scalars.csub(scalars.cmul(S(x, r[1]), S(h[0], r[0])), scalars.cmul(S(x, r[0]), S(h[0], r[1]))))):
            t = scalars.cmul(num, scalars.conj(det))
            out += [F.try_divide(t[0], dd).alias(f"Z_{x}_{h[k]}_re"), F.try_divide(t[1], dd).alias(f"Z_{x}_{h[k]}_im")]
    z = s.select(*keys, "n", "sw", *out, *([c for c in s.columns if c.startswith("S_")] if errors else []))
    if not errors:
        return z
    power = lambda c: c[0] * c[0] + c[1] * c[1]
    square = lambda a, b: scalars.cmul(a, scalars.conj(b))
    made = {}
    for x in e:
        zs = [_z(f"Z_{x}_{c}") for c in h]
        left = S(x, x)[0] + power(zs[0]) * S(h[0], h[0])[0] + power(zs[1]) * S(h[1], h[1])[0] + 2 * scalars.cmul(square(zs[0], zs[1]), S(h[0], h[1]))[0]
        for c, v in zip(h, zs, strict=True):
            left = left - 2 * square(S(x, c), v)[0]
        var = F.greatest(left, F.lit(0.0)) / F.when(F.col("n") > 2, F.col("n") - 2)
        for k, other in ((0, h[1]), (1, h[0])):
            p, q = S(other, r[1]), S(other, r[0])
            cross = scalars.cmul(square(p, q), scalars.conj(S(r[0], r[1])))
            spread = F.try_divide(var * (power(p) * S(r[0], r[0])[0] + power(q) * S(r[1], r[1])[0] - 2 * cross[0]), dd)
            made[f"Z_{x}_{h[k]}_err"] = F.when(spread.isNotNull(), F.sqrt(F.greatest(spread, F.lit(0.0))))
    return z.withColumns(made).drop(*[c for c in z.columns if c.startswith("S_")])


def in_bands(wide: DataFrame, bands: DataFrame) -> DataFrame:
    """Harmonics with the bands that hold them: `bands` is (band, i_min, i_max), with a level where `wide` has one. A harmonic in several bands
    counts in each. The table is opened to one row per band and harmonic, at most half a window each, and met by equality."""
    on = ["f"] + (["level"] if "level" in wide.columns and "level" in bands.columns else [])
    b = bands.select(*on[1:], "band", F.explode(F.sequence(F.col("i_min").cast("int"), F.col("i_max").cast("int"))).alias("f"))
    return wide.join(b, on)


def remote_reference(fc: DataFrame, keys: list[str], e: list[str] = ("ex", "ey"), h=("hx", "hy"), r=("rx", "ry"), band=None, iterations: int = 3,
                     bands: DataFrame | None = None, errors: bool = False) -> DataFrame:
    """(keys, band, comp, re, im, err, n): robust remote-reference impedance per station and band.

    `band` maps a harmonic to its band, or `bands` is the table of them (`in_bands`); `err` is there with `errors`. Every reweighting is one aggregate and one join on (keys, band); the number
    of them is fixed and the lineage is cut between them.
    """
    chans = list(dict.fromkeys([*e, *h, *r]))
    wide = _wide(fc, keys, chans)
    wide = in_bands(wide, bands) if bands is not None else wide.withColumn("band", F.col("f") if band is None else band).where(F.col("band").isNotNull())
    wide = wide.withColumn("w", F.lit(1.0))
    by = [*keys, "band"]
    wide = cut_lineage(wide)
    for step in range(iterations + 1):
        z = cut_lineage(solve(wide, by, list(e), h, r, errors and step == iterations))
        if step == iterations:
            break
        j = wide.join(z.drop("n", "sw"), by)
        total = F.lit(0.0)
        for x in e:
            p0, p1 = scalars.cmul(_z(f"Z_{x}_{h[0]}"), _z(h[0])), scalars.cmul(_z(f"Z_{x}_{h[1]}"), _z(h[1]))
            total = total + (F.col(x + "_re") - p0[0] - p1[0]) ** 2 + (F.col(x + "_im") - p0[1] - p1[1]) ** 2
        j = j.withColumn("_r", F.sqrt(total))
        scale = group_percentiles(j, by, "_r", {"_s": 0.5})
        wide = cut_lineage(j.join(scale, by).withColumn("w", F.when(F.col("_r") <= HUBER * F.col("_s"), 1.0).otherwise(F.try_divide(HUBER * F.col("_s"), F.col("_r"))))
                           .select(wide.columns))
    comps = F.array(*[F.struct(F.lit(f"{x}_{c}").alias("comp"), F.col(f"Z_{x}_{c}_re").alias("re"), F.col(f"Z_{x}_{c}_im").alias("im"),
                               *([F.col(f"Z_{x}_{c}_err").alias("err")] if errors else [])) for x in e for c in h])
    return z.select(*by, "n", "sw", F.explode(comps).alias("c")).select(*by, "c.*", "n", "sw")


def with_remote(local: DataFrame, reference: DataFrame, keys: list[str]) -> DataFrame:
    """Local channels with the reference pair renamed rx, ry on the segments both hold."""
    r = reference.where(F.col("chan").isin("hx", "hy")).withColumn("chan", F.when(F.col("chan") == "hx", "rx").otherwise("ry"))
    both = local.select(*keys, "seg").distinct().join(r.select(*keys, "seg").distinct(), [*keys, "seg"])
    return local.unionByName(r).join(both, [*keys, "seg"], "left_semi")

