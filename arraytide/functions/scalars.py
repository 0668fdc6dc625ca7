"""Scalars of a response element held as two doubles, and the masks on it."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values
FILL = 1e30
NO_INFO_ERR = 1e9


def magnitude(re: Column, im: Column) -> Column:
    return F.sqrt(re * re + im * im)


def rho(period: Column, re: Column, im: Column) -> Column:
    """Apparent resistivity 0.2 T |Z|^2."""
    return F.lit(0.2) * period * (re * re + im * im)


def phase(comp: Column, re: Column, im: Column) -> Column:
    """Phase in degrees, yx folded by +180 into the first quadrant."""
    p = F.degrees(F.atan2(im, re)) + F.when(comp == "yx", 180.0).otherwise(0.0)
    return F.when(p > 180, p - 360).otherwise(p)


def wrap180(deg: Column) -> Column:
    return F.pmod(deg + 180.0, F.lit(360.0)) - 180.0


def is_masked(re: Column, im: Column, err: Column) -> Column:
    """The fill value, the no-information error, or a zero with no usable bar; a zero with a real bar stays."""
    bar = F.coalesce((err > 0) & (err < NO_INFO_ERR), F.lit(False))
    gone = re.isNull() | im.isNull() | F.isnan(re) | F.isnan(im)
    return F.coalesce(gone | (magnitude(re, im) >= FILL) | F.coalesce(err >= NO_INFO_ERR, F.lit(False))
                      | ((re == 0) & (im == 0) & ~bar), F.lit(True))


def with_scalars(tf):
    """rho, rho_err, phase, phase_err and rel beside every element; the relative error is NULL where |Z| is zero."""
    re, im = F.col("re"), F.col("im")
    m = magnitude(re, im)
    rel = F.when((m > 0) & F.col("err").isNotNull(), F.col("err") / m)
    r = rho(F.col("period"), re, im)
    return tf.withColumns({"rho": r, "phase": phase(F.col("comp"), re, im), "rel": rel, "rho_err": 2 * r * rel,
                           "phase_err": F.degrees(rel)})


def cmul(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def cdiv(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    d = b[0] * b[0] + b[1] * b[1]
    return (a[0] * b[0] + a[1] * b[1]) / d, (a[1] * b[0] - a[0] * b[1]) / d


def csub(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] - b[0], a[1] - b[1]


def conj(a: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0], -a[1]
