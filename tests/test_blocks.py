"""Block edges must not show: every blocked operator against brute force and against itself at another block size."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from arraytide.operators import axis, blocks, intervals, islands, quantiles, robust


def brute_runs(pos):
    out, pos = [], sorted(pos)
    for p in pos:
        if out and p == out[-1][1] + 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return {tuple(r) for r in out}


@pytest.mark.parametrize("block", [3, 8, 1000])
def test_runs_match_brute_force(spark, block):
    rng = np.random.default_rng(1)
    pos = [int(p) for p in np.flatnonzero(rng.random(300) < 0.7) - 120]
    df = spark.createDataFrame([("a", p) for p in pos] + [("b", 5)], "k string, p long")
    got = islands.runs(df, ["k"], "p", block=block).collect()
    assert {(r.run_start, r.run_end) for r in got if r.k == "a"} == brute_runs(pos)
    assert all(r.run_len == r.run_end - r.run_start + 1 for r in got)


@pytest.mark.parametrize("block", [3, 20, 1000])
def test_gaps_are_what_the_runs_leave(spark, block):
    pos = [int(p) for p in np.flatnonzero(np.random.default_rng(15).random(200) < 0.4)]
    df = spark.createDataFrame([("a", p) for p in pos], "k string, p long")
    got = {p for r in islands.gaps(df, ["k"], "p", block=block).collect() for p in range(r.gap_start, r.gap_end + 1)}
    assert got == set(range(pos[0], pos[-1] + 1)) - set(pos)


@pytest.mark.parametrize("block", [4, 50])
def test_merged_intervals_cover_the_same_positions(spark, block):
    rng = np.random.default_rng(2)
    iv = [(int(a), int(a + w)) for a, w in zip(rng.integers(0, 400, 80), rng.integers(0, 15, 80))]
    df = spark.createDataFrame([("a", *i) for i in iv], "k string, s long, e long")
    got = sorted((r.s, r.e) for r in islands.merge_intervals(df, ["k"], "s", "e", block=block).collect())
    want = []
    for a, b in sorted(iv):
        if want and a <= want[-1][1]:
            want[-1][1] = max(want[-1][1], b)
        else:
            want.append([a, b])
    assert got == [tuple(w) for w in want]
    tagged = islands.island_of(df, ["k"], "s", "e", block=block).collect()
    starts = [w[0] for w in want]
    assert all(r.island == max(s for s in starts if s <= r.s) for r in tagged)


@pytest.mark.parametrize("strict", [False, True])
def test_neighbours_reach_across_blocks(spark, strict):
    vals = [None, 1.0, None, None, None, None, None, 2.0, 3.0, None]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(vals)], "k string, p long, v double")
    for r in blocks.neighbours(df, ["k"], "p", "v", 2, strict).collect():
        prev = [i for i in range(len(vals)) if vals[i] is not None and (i < r.p or (i == r.p and not strict))]
        nxt = [i for i in range(len(vals)) if vals[i] is not None and (i > r.p or (i == r.p and not strict))]
        assert r.prev_pos == (prev[-1] if prev else None) and r.next_pos == (nxt[0] if nxt else None)


def test_ranked_is_a_global_row_number(spark):
    df = spark.createDataFrame([(int(x),) for x in np.random.default_rng(3).permutation(200)], "x long")
    got = blocks.ranked(df, blocks.block_of("x", 7), [F.col("x")]).collect()
    assert all(r.rank == r.x + 1 for r in got)


def test_place_later_file_wins_and_gaps_stay(spark):
    rows = [("a", 0, 1.0, 1), ("a", 1, 2.0, 1), ("a", 1, 9.0, 2), ("a", 5, 3.0, 1)]
    placed = axis.place(spark.createDataFrame(rows, "k string, p long, v double, f int"), ["k"], "p", ["v"], ["f"])
    got = {r.p: r.v for r in axis.densify(placed, ["k"], "p", ["v"], block=2).collect()}
    assert got == {0: 1.0, 1: 9.0, 2: None, 3: None, 4: None, 5: 3.0}
    rec = axis.reconcile(spark.createDataFrame(rows, "k string, p long, v double, f int"), ["k"], "p").first()
    assert (rec.samples_read, rec.overlap_samples, rec.verdict) == (4, 1, "FAIL")


def test_interval_mask_is_the_range_predicate(spark):
    rng = np.random.default_rng(4)
    pts = [int(p) for p in rng.integers(0, 5000, 400)]
    iv = [(int(a), int(a) + int(w)) for a, w in zip(rng.integers(0, 5000, 30), rng.integers(1, 700, 30))]
    s = spark.createDataFrame([("a", p) for p in set(pts)], "k string, p long")
    i = spark.createDataFrame([("a", *x) for x in iv], "k string, s long, e long")
    inside = {p for p in pts if any(a <= p < b for a, b in iv)}
    assert {r.p for r in intervals.in_intervals(s, i, ["k"], "p", "s", "e").collect()} == set(pts) - inside
    assert {r.p for r in intervals.mark(s, i, ["k"], "p", "s", "e", "m").where("m").collect()} == inside


def test_percentiles_are_exact_for_small_tied_and_large_groups(spark):
    rng = np.random.default_rng(5)
    groups = {"one": [3.0], "two": [1.0, 4.0], "tied": [7.0] * 5000 + [8.0] * 10, "big": rng.normal(size=9001).tolist(),
              "half": np.round(rng.normal(size=6000), 1).tolist()}
    df = spark.createDataFrame([(k, float(v)) for k, g in groups.items() for v in g] + [("one", None)], "k string, v double")
    got = {r.k: r for r in quantiles.group_percentiles(df, ["k"], "v", {"m": 0.5, "q": 0.95, "z": 0.0}).collect()}
    for k, g in groups.items():
        for name, p in (("m", 50), ("q", 95), ("z", 0)):
            assert got[k][name] == pytest.approx(np.percentile(g, p), abs=1e-12), (k, name)
    mad = {r.k: r.mad for r in quantiles.group_mad(df, ["k"], "v").collect()}
    assert mad["big"] == pytest.approx(1.4826 * np.median(np.abs(np.array(groups["big"]) - np.median(groups["big"]))))


def test_others_median_leaves_one_out(spark):
    rng = np.random.default_rng(6)
    rows = [(s, f"s{k}", float(np.round(rng.normal(), 1))) for s, n in enumerate((1, 2, 3, 6, 9)) for k in range(n)]
    df = spark.createDataFrame(rows, "slot int, site string, v double")
    for r in quantiles.others_median(df, ["slot"], "v").collect():
        rest = [v for s, k, v in rows if s == r.slot and k != r.site]
        assert r.n_others == len(rest)
        assert (r.others_median is None) if not rest else r.others_median == pytest.approx(np.median(rest))


@pytest.mark.parametrize("block", [16, 1000])
def test_lanczos_shift_matches_the_sum(spark, block):
    n, d = 200, 2.37
    x = np.sin(np.arange(n) / 7.0)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "k string, i long, v double")
    got = {r.i: r.v for r in robust.shift(df, ["k"], "i", "v", d, block=block).collect() if r.v is not None}
    w = robust.lanczos_weights(0.37)
    for i in range(20, 150):
        assert got[i] == pytest.approx(sum(c * x[i + 2 + t] for t, c in zip(range(-15, 17), w)), abs=1e-12)
    col = {r.i: r.v for r in robust.shift(df, ["k"], "i", "v", F.lit(d), block=block).collect() if r.v is not None}
    assert max(abs(col[i] - got[i]) for i in got) < 1e-9
    back = max(abs(got[i] - np.sin((i + d) / 7.0)) for i in range(20, 150))
    assert back < 1e-2


def test_screens_do_not_depend_on_the_block(spark):
    rng = np.random.default_rng(7)
    x = [None if rng.random() < 0.1 else float(v) for v in np.cumsum(rng.normal(size=300))]
    x[150] = 500.0
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "k string, i long, v double")
    for op in (lambda b: robust.despike(df, ["k"], "i", "v", k=8.0, block=b), lambda b: robust.fill_short(df, ["k"], "i", "v", 2, block=b),
               lambda b: robust.screen_edges(df, ["k"], "i", "v", 3, block=b), lambda b: robust.steps_per_million(df, ["k"], "i", "v", 1.0, block=b)):
        a, b = ({tuple(r) for r in op(k).collect()} for k in (17, 10_000))
        assert a == b
    spiked = {r.i: r.v for r in robust.despike(df, ["k"], "i", "v", k=8.0, block=17).collect()}
    assert all(spiked[i] is None for i in range(147, 154))
