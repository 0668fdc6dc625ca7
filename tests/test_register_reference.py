import numpy as np
import pytest
from pyspark.sql import functions as F

from arraytide.operators import fleet, reference, register

DAY = 86400


def components(spans, need):
    names, adj = list(spans), {}
    for a in names:
        adj[a] = {b for b in names if b != a and round(max(0, min(spans[a][1], spans[b][1]) - max(spans[a][0], spans[b][0])) / DAY, 2) >= need}
    seen, out = set(), set()
    for a in names:
        if a in seen:
            continue
        todo, comp = [a], set()
        while todo:
            x = todo.pop()
            if x not in comp:
                comp.add(x)
                todo += adj[x]
        seen |= comp
        out.add(frozenset(comp))
    return out


@pytest.mark.parametrize("need", [0.5, 20.0, 45.0])
def test_overlap_groups_are_the_graph_components(spark, need):
    rng = np.random.default_rng(8)
    spans = {f"s{k:02d}": (int(a) * 3600, int(a + w) * 3600) for k, (a, w) in enumerate(zip(rng.integers(0, 9000, 40), rng.integers(1, 1500, 40)))}
    df = spark.createDataFrame([(k, a, z) for k, (a, z) in spans.items()], "site string, t_start long, t_end long")
    groups, members = register.overlap_groups(df, need)
    got = {}
    for r in members.collect():
        got.setdefault(r.group, set()).add(r.site)
    assert {frozenset(v) for v in got.values()} == components(spans, need)
    for g in groups.collect():
        s = [spans[x] for x in got[g.group]]
        assert g.n == len(s)
        assert g.common_days == pytest.approx(max(0.0, round((min(z for _, z in s) - max(a for a, _ in s)) / DAY, 2)), abs=0.011)


def test_active_days_and_peaks(spark):
    df = spark.createDataFrame([("a", 0, 9 * DAY), ("b", 4 * DAY, 12 * DAY), ("c", 20 * DAY, 22 * DAY)], "site string, t_start long, t_end long")
    act = {r.day: r.active for r in register.active_per_day(df).collect()}
    assert act[0] == 1 and act[5] == 2 and act[15] == 0 and act[22] == 1 and len(act) == 23
    assert [r.day for r in register.peaks(register.active_per_day(df)).collect()] == [4]


def test_nearest_is_exact_across_cells_and_the_date_line(spark):
    pts = [("a", 0.0, 179.9), ("b", 0.0, -179.9), ("c", 0.1, 179.0), ("d", -60.0, 10.0), ("e", -60.0, 100.0), ("f", 5.0, 175.0)]
    df = spark.createDataFrame(pts, "site string, lat double, lon double")
    got = {(r.site, r["rank"]): r.name for r in register.nearest(df, df, 2).collect()}

    def km(p, q):
        a, b, c, d = np.radians([p[1], p[2], q[1], q[2]])
        return np.arcsin(np.sqrt(np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2))
    for p in pts:
        want = sorted((q for q in pts if q != p), key=lambda q: km(p, q))[:2]
        assert [got[p[0], 1], got[p[0], 2]] == [w[0] for w in want]


def test_events_need_a_fleet_and_an_excess_over_it(spark):
    rows = [(s, k, c, 1.0) for s in "abcde" for k in range(20) for c in ("hx", "hy")]
    rows = [(s, k, c, 1000.0 if (s == "a" and k == 3) or k == 7 else p) for s, k, c, p in rows]
    df = spark.createDataFrame(rows, "site string, slot long, chan string, power double")
    bad = {(r.site, r.slot) for r in fleet.event_flags(df, ["hx", "hy"]).where("bad").collect()}
    assert bad == {("a", 3)}          # slot 7 is loud everywhere: the source field, not a fault
    small = df.where(F.col("site").isin("a", "b"))
    assert fleet.event_flags(small, ["hx", "hy"]).where("bad").isEmpty()
    pool = {r.site: r.clean for r in fleet.clean_pool(df, fleet.event_flags(df, ["hx", "hy"]), ["hx", "hy"]).collect()}
    assert not pool["a"] and pool["b"]


CAND = "target string, name string, km double, overlap_days double, overlap_frac double, event_frac double, clean boolean, coh double, ok boolean"


@pytest.mark.parametrize("rows,want", [
    ([("n", 10.0, 50.0, 0.95, 0.0, True, 0.6, True), ("m", 5.0, 50.0, 0.95, 0.0, True, 0.4, True)], ("n", 1)),
    ([("n", 10.0, 50.0, 0.5, 0.0, True, 0.6, True), ("m", 50.0, 60.0, 0.6, 0.0, True, 0.7, True)], ("m", 2)),
    ([("n", 10.0, 50.0, 0.5, 0.0, True, 0.35, True), ("m", 5.0, 60.0, 0.6, 0.0, True, 0.31, True)], ("n", 3)),
    ([("n", 10.0, 50.0, 0.5, 0.3, False, 0.6, True), ("m", 50.0, 60.0, 0.6, 0.2, False, 0.6, True)], ("m", 4)),
    ([("n", 10.0, 50.0, 0.5, 0.3, False, 0.1, True), ("m", 5.0, 60.0, 0.6, 0.2, False, None, True)], ("m", 5)),
    ([("n", 10.0, 1.0, 0.1, 0.3, True, None, False), ("m", 50.0, 1.0, 0.1, 0.2, True, None, False)], ("n", 5)),
])
def test_five_branches(spark, rows, want):
    r = reference.remote_choice(spark.createDataFrame([("t", *x) for x in rows], CAND)).first()
    assert (r["name"], r.branch) == want


def fleet_members(n=600):
    t = np.arange(n)
    common = 20 * np.sin(t / 50.0)
    rng = np.random.default_rng(9)
    return {m: common + 0.05 * rng.normal(size=n) + off for m, off in (("a", 0.0), ("b", 400.0), ("c", -250.0), ("d", 90.0))}


def as_frame(spark, members):
    return spark.createDataFrame([("t", m, i, None if v != v else float(v)) for m, x in members.items() for i, v in enumerate(x)],
                                 "target string, member string, i long, x double")


def test_a_spike_is_bridged_and_a_shared_step_is_not(spark):
    m = fleet_members()
    m["b"][300] += 900.0
    for x in m.values():
        x[100:] += 50.0
    out = reference.member_screen(as_frame(spark, m), block=64).collect()
    b = {r.i: r for r in out if r.member == "b"}
    assert b[300].bridged and abs(b[300].x - m["b"][297]) < 5
    assert not any(r.flagged for r in out if 90 <= r.i <= 110)


def test_level_match_sets_members_on_one_level_and_the_stack_has_a_floor(spark):
    m = fleet_members()
    m["c"][400:] = np.nan
    m["d"][:] = np.nan
    axis = spark.createDataFrame([("t", 0, 600)], "target string, t0 long, n long")
    lv = reference.level_match(as_frame(spark, m), axis, block=10, nwin=12, axis_block=64)
    w = spark.createDataFrame([("t", k, 1.0) for k in "abcd"], "target string, member string, weight double")
    st = {r.i: r for r in reference.stack(lv, w).collect()}
    assert st[200].n_members == 3 and st[500].n_members == 2 and st[500].mask
    at = {r.member: r.x for r in lv.where("i = 200").collect()}
    assert abs(at["a"] - at["b"]) < 0.5 and abs(at["a"] - at["c"]) < 0.5
    raw = {r.i: r.x for r in reference.stack(as_frame(spark, m), w).where("i in (399, 400)").collect()}
    step = max(abs(st[i + 1].x - st[i].x) for i in range(599))
    assert step < 0.2 * abs(raw[400] - raw[399])          # the member that drops out no longer steps the level


def test_core_groups_count_every_covering_span_without_a_row_per_day(spark):
    rng = np.random.default_rng(3)
    rows = [(k, "ab"[k % 2], int(a), int(a + w)) for k, (a, w) in enumerate(zip(rng.integers(-20 * DAY, 9000 * DAY, 300), rng.integers(0, 9000 * DAY, 300)))]
    rows += [(900, "a", 5 * DAY, 19 * DAY), (901, "a", 5 * DAY, 18 * DAY), (902, "b", 12 * DAY, 26 * DAY - 1)]
    spans = spark.createDataFrame(rows, "site long, instrument string, t_start long, t_end long")
    days = [-3, 0, 12, 19, 64, 4095, 4096, 8192, 9001, 17000]
    peak_days = spark.createDataFrame([(d,) for d in days], "day long")
    want, members = {}, set()
    for d in days:
        for s, i, a, z in rows:
            if a <= (d - 7) * DAY and z >= (d + 7) * DAY:
                n, x, y = want.get((d, i), (0, a, z))
                want[d, i] = (n + 1, max(x, a), min(y, z))
                members.add((d, s))
    got = register.core_groups(spans, peak_days).collect()
    assert {(r.day, r.instrument): (r.n_core, r.common_start, r.common_end) for r in got} == want and len(got) == len(want)
    made = [(r.day, r.site) for r in register.core_members(spans, peak_days).collect()]
    assert set(made) == members and len(made) == len(members)
    # 300 spans of 4500 days on average: far fewer rows than their days
    assert register._covered(spans, 7, "t_start", "t_end").count() < 30 * len(rows)
