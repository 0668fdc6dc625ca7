"""What file, run and response names say: stems, stamps, kinds, selections, forms."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values
KINDS = ("single", "remote", "stack", "obs", "stack_obs")
SELECTION_TAGS = ("whole", "stretch", "control")
SCRIPT_EXTENSIONS = ("bat", "lnk", "txt~", "db")
ROLLOVER_DAYS = 7168
ROLLOVER_LABEL = "+1024 weeks"
KIND_PATTERN = "stack_obs|single|remote|stack|obs"
FORM_PATTERN = (r"^(whole|whole10|diagonal|recipe|recipe_[xy]|window_(xy|yx)(_control)?|merged_(xy|yx)"
                r"|replace_H[xy]_[A-Za-z0-9]+|lender_[A-Za-z0-9]+)$")


def drop_reason(name: Column) -> Column:
    """Why a file name is not a data file of the station, or ''."""
    bench = F.lower(name).startswith("lab_") | F.lower(name).contains("_test")
    ext = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1))
    return (F.when(name.startswith("._"), "AppleDouble").when(bench, "LAB_/test")
            .when(ext.isin(*SCRIPT_EXTENSIONS), "operator script").otherwise(""))


def stem(name: Column) -> Column:
    return F.regexp_extract(name, r"^(.*)\d{12}\.[^.]*$", 1)


def stamp(name: Column) -> Column:
    """The 12 digits before the extension, '' where there are none."""
    return F.regexp_extract(name, r"(\d{12})\.[^.]*$", 1)


def extension(name: Column) -> Column:
    return F.regexp_extract(name, r"\.([^.]*)$", 1)


def stamp_time(s: Column) -> Column:
    """YYMMDDhhmmss as a timestamp, before any rollover."""
    part = lambda k: F.substring(s, k, 2).try_cast("int")
    return F.when(F.length(s) == 12, F.try_make_timestamp(
        F.lit(2000) + part(1), part(3), part(5), part(7), part(9), part(11).cast("double")))


def corrected(ts: Column, first_year: int | None) -> tuple[Column, Column]:
    """(time, label): a GPS week rollover is undone where the year lies before every year of the survey."""
    if first_year is None:
        return ts, F.lit("")
    back = F.year(ts) < first_year
    return (F.when(back, ts + F.expr(f"INTERVAL {ROLLOVER_DAYS} DAYS")).otherwise(ts),
            F.when(back, ROLLOVER_LABEL).otherwise(F.lit("")))


def run_and_stamp(folder: Column) -> tuple[Column, Column]:
    """A run folder <run>_<YYYYmmdd_HHMM>; the whole name is the run where no stamp ends it."""
    pat = r"^(.+)_(\d{8}_\d{4})$"
    s = F.regexp_extract(folder, pat, 2)
    return F.when(s == "", folder).otherwise(F.regexp_extract(folder, pat, 1)), s


def response_name(site: Column, kind: Column, rate: Column, selection: Column, params: Column) -> Column:
    """<site>_<kind>_<rate>hz_[<selection>_]<params>; the whole record carries no selection."""
    tag = F.when(F.coalesce(selection, F.lit("")).isin("", "whole", "nan"), F.lit("")).otherwise(F.concat(selection, F.lit("_")))
    return F.concat(site, F.lit("_"), kind, F.lit("_"), rate.cast("int").cast("string"), F.lit("hz_"), tag, params)


def parse_response(name: Column) -> dict[str, Column]:
    """The columns a response's file name carries; every one '' where the name does not read."""
    pat = rf"^(.+?)_({KIND_PATTERN})_(\d+)hz_(.+)$"
    rest = F.regexp_extract(name, pat, 4)
    sel = F.when(rest.startswith("stretch_"), "stretch").when(rest.startswith("control_"), "control").otherwise("whole")
    return {"site": F.regexp_extract(name, pat, 1), "kind": F.regexp_extract(name, pat, 2),
            "rate_hz": F.regexp_extract(name, pat, 3).try_cast("double"), "selection": F.when(rest == "", "").otherwise(sel),
            "params": F.regexp_replace(rest, "^(stretch|control)_", "")}


def is_form(name: Column) -> Column:
    return name.rlike(FORM_PATTERN)


def response_key(kind: Column, rate: Column, selection: Column, form: Column) -> Column:
    """What an analyst writes to name a response: its form, or kind_rate[_selection]."""
    tag = F.when(F.coalesce(selection, F.lit("")).isin("", "whole", "nan"), F.lit("")).otherwise(F.concat(F.lit("_"), selection))
    return F.when(F.coalesce(form, F.lit("")) != "", form).otherwise(
        F.concat(kind, F.lit("_"), rate.cast("int").cast("string"), F.lit("hz"), tag))


def ddmm(value: Column, hemisphere: Column) -> Column:
    """DDMM.MMMM with a hemisphere letter to signed degrees."""
    v = value.try_cast("double")
    d = F.floor(v / 100)
    return (d + (v - 100 * d) / 60.0) * F.when(F.upper(hemisphere).isin("S", "W"), -1.0).otherwise(1.0)


def clean_line(c: Column) -> Column:
    """A header line with nothing in it a reader splits on."""
    return F.trim(F.translate(c, "|\n\r", "   "))


def key_values(lines: Column) -> Column:
    """An array of key=value lines as a map; the first of a repeated key stands, lines without '=' are dropped."""
    kv = F.transform(F.filter(lines, lambda x: x.contains("=")),
                     lambda x: F.struct(F.trim(F.regexp_extract(x, "^([^=]*)=", 1)).alias("k"),
                                        F.trim(F.regexp_extract(x, "(?s)^[^=]*=(.*)$", 1)).alias("v")))
    keys, vals = F.transform(kv, lambda x: x["k"]), F.transform(kv, lambda x: x["v"])
    once = F.array_distinct(keys)
    return F.map_from_arrays(once, F.transform(once, lambda k: F.get(vals, (F.array_position(keys, k) - 1).cast("int"))))
