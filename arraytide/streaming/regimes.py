"""Deployments split as their daily fixes arrive: a running median position per folder, held as state."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.geo import EARTH_RADIUS_KM


def _km(a: tuple[float, float], b: tuple[float, float]) -> float:
    p1, p2 = np.radians(a[0]), np.radians(b[0])
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(b[1] - a[1]) / 2) ** 2
    return float(2 * EARTH_RADIUS_KM * np.arcsin(min(1.0, np.sqrt(h))))


def clusters(stream: DataFrame, folder: str, order: str, split_km: float = 1.0) -> DataFrame:
    """(folder, order, cluster) as fixes arrive; the state is the fixes of the current cluster, one a day."""
    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, la, lo = (state.get[0], list(state.get[1]), list(state.get[2])) if state.exists else (0, [], [])
        # the fixes of one folder in one trigger, one a day: in order before they are split, whatever batches they came in
        out = []
        for r in pd.concat(list(batches)).sort_values(order).itertuples(index=False):
            p = (float(r.lat), float(r.lon))
            if la and _km((float(np.median(la)), float(np.median(lo))), p) > split_km:
                n, la, lo = n + 1, [], []
            la.append(p[0])
            lo.append(p[1])
            out.append((key[0], getattr(r, order), n))
        yield pd.DataFrame(out, columns=[folder, order, "cluster"])
        state.update((n, la, lo))

    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    return stream.groupBy(folder).applyInPandasWithState(
        step, f"{folder} {kinds[folder]}, {order} {kinds[order]}, cluster long", "n long, lat array<double>, lon array<double>", "append", GroupStateTimeout.NoTimeout)
