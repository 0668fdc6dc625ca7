"""Station-level judgements against neighbours, controls and forms; checks and manifests."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import register

# fixed thresholds
F_TOLERANCE = 0.05
FLUCTUATION = 3.0
SUB_THRESHOLD, SUB_CLEARLY, DONOR_GATE, COVER_GATE = 0.5, 0.7, 0.80, 0.95
CONTROL_EX_EY_MAX = 0.35
COPY_COH, LEAK_OWN, LEAK_NEIGHBOUR = 0.99, 0.95, 0.10
RESID_COH_MIN, GAIN_LO, GAIN_HI = 0.9, 0.85, 1.18
BAR_MARGIN = 0.20


def daily_magnetics(days: DataFrame, stations: DataFrame, k: int = 2) -> DataFrame:
    """A day is sound where its field matches the model and its fluctuations its nearest recording neighbours'.

    `days` is (site, day, f_ratio, hx_std, hz_std), stations (site, lat, lon). A station has k neighbours, so the
    day join multiplies rows by k at most.
    """
    near = register.nearest(stations, stations, k).select("site", "name")
    nb = days.select(F.col("site").alias("name"), "day", F.col("f_ratio").alias("_f"), F.col("hx_std").alias("_x"), F.col("hz_std").alias("_z")).where(F.col("_f").isNotNull())
    ref = near.join(nb, "name").groupBy("site", "day").agg(F.count(F.lit(1)).alias("n_neighbours"), F.median("_x").alias("nb_hx_std"), F.median("_z").alias("nb_hz_std"))
    d = days.join(ref, ["site", "day"], "left")
    f_ok = F.coalesce(F.abs(F.col("f_ratio") - 1) < F_TOLERANCE, F.lit(False))
    within = lambda a, b: (F.col(a) >= F.col(b) / FLUCTUATION) & (F.col(a) <= F.col(b) * FLUCTUATION)
    judged = F.col("f_ratio").isNotNull() & F.col("n_neighbours").isNotNull()
    sound = F.when(F.col("f_ratio").isNull(), False).when(~judged, f_ok).otherwise(f_ok & within("hx_std", "nb_hx_std") & within("hz_std", "nb_hz_std"))
    why = (F.when(F.col("f_ratio").isNull(), "no data").when(~judged, "F only: no neighbour recorded that day").when(sound, "")
           .when(~f_ok, "F off the model").otherwise("fluctuation off the neighbours"))
    return d.select("site", "day", "f_ratio", F.coalesce("n_neighbours", F.lit(0)).alias("n_neighbours"), "nb_hx_std", "nb_hz_std", sound.alias("sound"), judged.alias("judged"), why.alias("reason"))


def lender_candidates(pairs: DataFrame, near: DataFrame, gate: float = DONOR_GATE) -> DataFrame:
    """Each station's candidate lenders, vouched for by the best third station among the other candidates.

    `pairs` is symmetric (a, b, coh_hx, coh_hy); `near` is (site, candidate, km, coverage) with a few candidates
    per station, which bounds the triple.
    """
    own = pairs.select(F.col("a").alias("site"), F.col("b").alias("candidate"), F.col("coh_hx").alias("own_hx"), F.col("coh_hy").alias("own_hy"))
    third = (near.select("site", "candidate").join(near.select("site", F.col("candidate").alias("third")), "site").where(F.col("candidate") != F.col("third"))
             .join(pairs.select(F.col("a").alias("candidate"), F.col("b").alias("third"), "coh_hx", "coh_hy"), ["candidate", "third"])
             .groupBy("site", "candidate").agg(F.max_by(F.struct("third", "coh_hx", "coh_hy"), F.struct(F.round(F.least("coh_hx", "coh_hy"), 12), F.col("third"))).alias("_t")))
    d = near.join(own, ["site", "candidate"], "left").join(third, ["site", "candidate"], "left")
    worst = F.when(F.coalesce(F.col("own_hx") < F.col("own_hy"), F.lit(False)), "hx").otherwise("hy")
    d = d.withColumn("worst_channel", worst)
    wv = F.when(F.col("worst_channel") == "hx", F.col("own_hx")).otherwise(F.col("own_hy"))
    ov = F.when(F.col("worst_channel") == "hx", F.col("own_hy")).otherwise(F.col("own_hx"))
    dv = F.when(F.col("worst_channel") == "hx", F.col("_t.coh_hx")).otherwise(F.col("_t.coh_hy"))
    sound = F.coalesce(dv >= gate, F.lit(False))
    return d.select("site", "candidate", "km", F.col("_t.third").alias("third"), "worst_channel", sound.alias("donor_sound"),
                    F.coalesce((wv < SUB_THRESHOLD) & (wv < SUB_CLEARLY * ov) & sound, F.lit(False)).alias("rule_fires"),
                    F.coalesce(F.col("coverage") >= COVER_GATE, F.lit(False)).alias("covers"))


def tipper_refusal(coh: DataFrame) -> DataFrame:
    """Copy and leak from (site, hz_hx, hz_hy, hz_neighbour): whether the tipper is refused and on which fault."""
    own = F.greatest("hz_hx", "hz_hy")
    copy = F.coalesce(F.col("hz_hx") >= COPY_COH, F.lit(False))
    leak = F.coalesce((own >= LEAK_OWN) & (F.col("hz_neighbour") < LEAK_NEIGHBOUR), F.lit(False))
    return coh.withColumns({"coh_own": own, "refused": copy | leak,
                            "reason": F.concat_ws("; ", F.when(copy, "a copy"), F.when(leak, "a leak"))})


def control_site(days: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group the station with the lowest daily maximum Ex-Ey coherence and whether it clears the ceiling."""
    g = days.where(F.col("coh_ex_ey").isNotNull()).groupBy("site").agg(F.max("coh_ex_ey").alias("mx"), F.median("coh_ex_ey").alias("md"), F.count(F.lit(1)).alias("days"))
    b = g.join(groups, "site").groupBy("group").agg(F.min(F.struct(F.round("mx", 12).alias("mx"), F.round("md", 12).alias("md"), F.col("site").alias("site"), F.col("days").alias("days"))).alias("_b"))
    return b.select("group", "_b.*", (F.col("_b.mx") < CONTROL_EX_EY_MAX).alias("qualifies"))


def top_days(days: DataFrame, keys: list[str], score: str, day: str, usable: Column, n: int = 3) -> DataFrame:
    """The first n usable days by falling score."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), day)
    return days.where(usable & F.col(score).isNotNull()).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def centre_verdict(days: DataFrame, keys: list[str]) -> DataFrame:
    """Shared-centre model over the scored days: medians, the gain against the arm ratio, which sign is clean."""
    g = days.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_days"), F.median("coh_r").alias("coh_r"), F.median("gain").alias("gain"), F.median("mcoh_diff").alias("mcoh_diff"),
                                F.median("mcoh_sum").alias("mcoh_sum"), F.sum("s_obs").alias("_s"), F.first("gain_expected").alias("gain_expected"), F.max("src").alias("_src"))
    ratio = F.col("gain") / F.col("gain_expected")
    holds = (F.col("coh_r") >= RESID_COH_MIN) & (ratio >= GAIN_LO) & (ratio <= GAIN_HI)
    s = F.when(F.col("_s") < 0, -1.0).otherwise(1.0)
    by_h = F.when(F.col("mcoh_diff") > F.col("mcoh_sum"), "diff").otherwise("sum")
    obs = F.when(s > 0, "diff").otherwise("sum")
    return g.select(*keys, "n_days", "coh_r", ratio.alias("gain_ratio"), holds.alias("model_holds"), s.alias("s_obs"), obs.alias("clean_obs"), by_h.alias("clean_by_h"),
                    (holds & (by_h == obs)).alias("remedy"), (F.col("_src") < CONTROL_EX_EY_MAX).alias("control"))


def forms_table(forms: DataFrame, margin: float = BAR_MARGIN) -> DataFrame:
    """Each form against every control it names: a candidate only where it beats all that were made.

    `forms` is (site, form, bar, status, controls array, inter_site, judged_on).
    """
    bars = forms.select("site", F.col("form").alias("ctl"), F.when(F.col("status") == "made", F.col("bar")).alias("ctl_bar"))
    one = forms.select("site", "form", "bar", F.explode("controls").alias("ctl")).join(bars, ["site", "ctl"], "left").where(F.col("ctl_bar").isNotNull())
    g = one.groupBy("site", "form").agg(F.bool_and(F.coalesce((F.col("bar") <= (1.0 - margin) * F.col("ctl_bar")) & (F.col("ctl_bar") > 0), F.lit(False))).alias("_wins"), F.count(F.lit(1)).alias("n_controls"))
    d = forms.join(g, ["site", "form"], "left")
    wins = F.coalesce("_wins", F.lit(False))
    v = (F.when(F.col("status") == "refused", "refused").when(F.col("status") != "made", "NOT MADE").when(F.col("inter_site"), "inter-site: not a response")
         .when(F.col("judged_on") != "bar", "read, not on the bar").when(F.size("controls") == 0, "read, no control")
         .when(F.col("n_controls").isNull(), "UNJUDGED: no control was made").when(wins, "beats its controls").otherwise("does not beat its controls"))
    cand = wins & (F.col("status") == "made") & ~F.col("inter_site") & (F.col("judged_on") == "bar")
    return d.select("site", "form", v.alias("verdict"), F.coalesce("n_controls", F.lit(0)).alias("n_controls"), cand.alias("candidate"))


def verdict_counts(checks: DataFrame, by: list[str]) -> DataFrame:
    """PASS, FAIL and UNJUDGED counts per check; one that scored nothing is UNJUDGED and counts as a failure."""
    v = F.when(F.col("n_scored") == 0, "UNJUDGED").otherwise(F.col("verdict"))
    g = checks.withColumn("_v", v).groupBy(*by).agg(*[F.count_if(F.col("_v") == x).alias(x.lower()) for x in ("PASS", "FAIL", "UNJUDGED")])
    return g.withColumn("failed", F.col("fail") + F.col("unjudged") > 0)


def manifest(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of delivered files, from a binaryFile scan."""
    return files.select("path", F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest_check(recorded: DataFrame, found: DataFrame) -> DataFrame:
    """Each recorded file: is it there, and is it the file that was recorded."""
    f = found.select("path", F.col("sha256").alias("_now"))
    d = recorded.join(f, "path", "left")
    return d.select("path", F.col("_now").isNotNull().alias("exists"), F.coalesce(F.col("_now") == F.col("sha256"), F.lit(False)).alias("sha256_matches"))


def caveats(decisions: DataFrame, key: str, open_cells: str, assumed: str) -> DataFrame:
    """One row per open or assumed input of a run."""
    row = lambda c, s: F.transform(F.filter(F.split(F.col(c), ", "), lambda x: x != ""), lambda x: F.struct(x.alias("input"), F.lit(s).alias("state")))
    return decisions.select(key, F.explode(F.concat(row(open_cells, "open"), row(assumed, "assumed"))).alias("c")).select(key, "c.*")
