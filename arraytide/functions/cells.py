"""The cell grammar of the survey tables: a value, `assume:<value>`, `decide` or nothing.

Every cell is text. A reader returns struct(value, state) and never a bare NULL, because undecided, assumed and
absent are three different things.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

DECIDE = "decide"
ASSUME = "assume:"
# fixed values of the grammar
BLANK_WORDS = ("", "nan", "<na>")
EMPTY_WORDS = ("", "nan", "none", "<na>")
NOTHING_WORDS = ("", "nan", "none", "<na>", "decide")
YES_WORDS = ("yes", "y", "true")
NO_WORDS = ("no", "n", "false")


def text(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def low(c: Column) -> Column:
    return F.lower(text(c))


def is_blank(c: Column) -> Column:
    """Nothing was supplied. `none` is a decision and so is not blank."""
    return low(c).isin(*BLANK_WORDS)


def is_empty(c: Column) -> Column:
    """The cell holds nothing, `none` included."""
    return low(c).isin(*EMPTY_WORDS)


def is_decide(c: Column) -> Column:
    return low(c) == DECIDE


def is_assumed(c: Column) -> Column:
    return F.lower(F.coalesce(c.cast("string"), F.lit(""))).startswith(ASSUME)


def after_assume(s: Column) -> Column:
    """What follows the prefix of an assumed cell, whole."""
    return F.right(s, F.char_length(s) - len(ASSUME))


def _number(s: Column) -> Column:
    v = s.try_cast("double")
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")), v)


def length(c: Column) -> Column:
    """An arm length: struct(value, state) with state value, assume or missing."""
    s = text(c)
    assumed = low(c).startswith(ASSUME)
    v = F.when(assumed, _number(F.trim(after_assume(s)))).otherwise(_number(s))
    return F.struct(v.alias("value"),
                    F.when(assumed, "assume").when(v.isNull(), "missing").otherwise("value").alias("state"))


def sign(c: Column) -> Column:
    """A sign cell: +1 or -1 and decided, anything else +1 and undecided."""
    v = _number(low(c))
    ok = F.coalesce(v.isin(1.0, -1.0), F.lit(False))
    return F.struct(F.when(ok, v).otherwise(F.lit(1.0)).alias("value"), ok.alias("decided"))


def yes_no(c: Column) -> Column:
    s = low(c)
    return F.struct(s.isin(*YES_WORDS).alias("value"), s.isin(*YES_WORDS, *NO_WORDS).alias("decided"))


def number(c: Column, default: float) -> Column:
    """A numeric decision; `assume:` is read through, unreadable gives the default and undecided."""
    s = low(c)
    s = F.when(s.startswith(ASSUME), F.trim(after_assume(s))).otherwise(s)
    v = F.when(~s.isin(*NOTHING_WORDS), _number(s))
    return F.struct(F.coalesce(v, F.lit(float(default))).alias("value"), v.isNotNull().alias("decided"))


def name(c: Column) -> Column:
    """A station name, or '' for none, decide and nothing."""
    return F.when(low(c).isin(*NOTHING_WORDS), F.lit("")).otherwise(text(c))


def lender_channels(c: Column) -> Column:
    """The magnetic channels a lender supplies, in channel order; all three where none is named."""
    s = low(c)
    want = F.split(F.trim(F.regexp_replace(s, ",", " ")), r"\s+")
    picked = F.filter(F.array(F.lit("hx"), F.lit("hy"), F.lit("hz")), lambda x: F.array_contains(want, x))
    return F.when(s.isin(*NOTHING_WORDS, "all"), F.array(F.lit("hx"), F.lit("hy"), F.lit("hz"))).otherwise(picked)


def tidy_serial(c: Column) -> Column:
    """A logger id written as a float string back to its digits: 5437.0 to 5437, never 10 to 1."""
    s = text(c)
    v = s.try_cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return (F.when(low(c).isin("", "nan", "none"), F.lit("")).when(v.isNull(), s).when(~finite, F.lit(""))
            .when(v == F.floor(v), F.floor(v).cast("bigint").cast("string")).otherwise(s))
