"""The lender chain on the daily record of the regions: region 0 borrows from 1, which borrows from 2 itself, and region 3 two channels from 4."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decisions
from ..plans import lending
from ..session import cut_lineage
from .bind import DAY_BLOCK, RAX, REC, RGN, rax, with_
from .registry import query

LENDS = """ld AS (SELECT r_regionkey AS site, CASE r_regionkey WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 3 THEN 4 END AS lender, CASE r_regionkey WHEN 0 THEN 2 WHEN 1 THEN -3 ELSE 0 END AS lag FROM region),
lo AS MATERIALIZED (SELECT site, i, CASE site WHEN 1 THEN hy ELSE hx END / CASE site WHEN 4 THEN 1.25 ELSE 1 END AS hx, CASE site WHEN 1 THEN hx ELSE hy END / CASE site WHEN 4 THEN 1.25 ELSE 1 END * CASE site WHEN 2 THEN -1 ELSE 1 END AS hy,
  hz / CASE site WHEN 4 THEN 1.25 ELSE 1 END AS hz, CASE WHEN site % 2 = 0 THEN -ex ELSE ex END AS ex, ey FROM rax),
la AS (SELECT site, atan2(avg(hy) FILTER (WHERE hx IS NOT NULL), avg(hx) FILTER (WHERE hy IS NOT NULL)) AS a FROM lo GROUP BY site),
lt AS (SELECT ld.site, i - ld.lag AS i, cos(a) * hx + sin(a) * hy AS hx, -sin(a) * hx + cos(a) * hy AS hy, hz FROM ld JOIN lo ON lo.site = ld.lender JOIN la ON la.site = ld.lender)"""


def lends(t):
    """The decision cells of the regions."""
    k = F.col("r_regionkey")
    cell = {"e_exchange": F.lit("no"), "h_exchange": F.when(k == 1, "yes").otherwise("no"), "h_gain": F.when(k == 4, "1.25").otherwise("1"), "e_shift_s": F.lit("0"),
            "sign_hx": F.lit("1"), "sign_hy": F.when(k == 2, "-1").otherwise("1"), "sign_hz": F.lit("1"), "sign_ex": F.when(k % 2 == 0, "-1").otherwise("1"), "sign_ey": F.lit("1"),
            "h_lender": F.when(k == 0, "1").when(k == 1, "2").when(k == 3, "4").otherwise("none"), "h_lender_channels": F.when(k == 3, "hx hy").otherwise("all"),
            "dipole_n_m": F.lit("50"), "dipole_e_m": F.lit("50")}
    return decisions.decision_values(t.region.select(k.cast("bigint").alias("site"), *[c.alias(n) for n, c in cell.items()]), "site")


@query("lent_records", "site:b i:b hx:d hy:d hz:d ex:d ey:d", "S17 P7 J18 J2 W8", with_(REC, RGN, RAX, LENDS)
       + """SELECT lo.site, lo.i, CASE WHEN lender IS NULL THEN lo.hx ELSE cos(a) * lt.hx - sin(a) * lt.hy END AS hx, CASE WHEN lender IS NULL THEN lo.hy ELSE sin(a) * lt.hx + cos(a) * lt.hy END AS hy,
  CASE WHEN lo.site IN (0, 1) THEN lt.hz ELSE lo.hz END AS hz, ex, ey FROM lo JOIN la ON la.site = lo.site JOIN ld ON ld.site = lo.site LEFT JOIN lt ON lt.site = lo.site AND lt.i = lo.i""")
def lent_records(t):
    lag = t.region.select(F.col("r_regionkey").cast("bigint").alias("site"), F.when(F.col("r_regionkey") == 0, 2.0).when(F.col("r_regionkey") == 1, -3.0).otherwise(0.0).alias("lag_s"))
    return lending.decided(cut_lineage(rax(t)), lends(t), "site", "i", lag=lag, block=DAY_BLOCK)[0]
