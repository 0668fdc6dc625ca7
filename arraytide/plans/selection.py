"""The selection job: every station's stretch and its control, both measured against the keep mask."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import stretches
from ..session import cut_lineage


def select_stretches(scores: DataFrame, kept: DataFrame, keys: list[str], hour: str, lines: list[str], pos: str,
                     coh_min: float = stretches.COH_MIN, max_hours: int = stretches.MAX_HOURS, seed: int = 0,
                     scale: int = 3600, min_run: int = 3600, block: int = stretches.HOUR_BLOCK) -> DataFrame:
    """(keys, rule, t_start, t_end, hours, n_runs_kept, kept_samples, refused) for every station at once.

    `scores` is the hour table and `kept` the sample positions the mask keeps; `scale` samples make one hour.
    A refused row keeps its bounds, so what was chosen is still reported.
    """
    scores = cut_lineage(scores)  # one row per hour, read by all that follows
    best = stretches.longest_stretch(scores, keys, hour, lines, coh_min, max_hours, block)
    spans = scores.groupBy(*keys).agg(F.min(hour).alias("t0"), (F.max(hour) + 1).alias("t1"))
    ctrl = stretches.control_stretch(best, spans, keys, seed)
    cols = [*keys, "t_start", "t_end", "hours"]
    both = (best.select(*cols).withColumn("rule", F.lit("stretch"))
            .unionByName(ctrl.select(*cols).withColumn("rule", F.lit("control"))))
    masked = kept.withColumn("rule", F.explode(F.array(F.lit("stretch"), F.lit("control"))))
    return stretches.verdict(both, masked, [*keys, "rule"], pos, scale, min_run, block * scale)
