"""N-gram Jaccard join with count vectors: documents as points of shingle counts per hash group, searched as an R-tree, verified exactly.

A document is its set of distinct `k`-word shingles. Shingles are hashed into groups. Two uses of the groups:

* The top of the index cuts each set into so many groups that a linked pair, whose sets differ in at most n (1 - t) / t shingles, leaves some
  group untouched. Documents therefore meet under (group, its content): that is exact, no pair at or over the threshold is missed, and a
  shingle that many documents share leads nowhere unless it is a whole group. Sizes of one octave share their cut; smaller documents also
  enter the next octave's.
* Below it a document is a point of group counts. The overlap of two sets is at most the sum of the smaller coordinates, and the overlap of
  anything in two boxes at most that sum over the boxes' upper corners. Leaves of points are compared box by box, then point by point; what the
  bound leaves is verified on the texts.

A group of documents is not expanded into its pairs: members are verified against the smallest member first, what that connects is one
component, and only pairs across components are searched further. Equal sets are one node from the start. The search cuts a group into blocks
in order of size, the members of its largest component apart, and a task gets two blocks whose corners leave the threshold within reach.

Sets are compared by 64-bit shingle hashes, and a set is known by a 64-bit hash. Defined results: a text without words, or null, has the empty
set and links with nothing; a null doc_id can link and names no component; repeated rows are equal sets; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arraytide.llm import common, rounds
from arraytide.llm.components import components
from arraytide.llm.hashing import U, mix, windows, words

LEAST_GROUPS, MOST_GROUPS = 64, 4096
LEAF, BLOCK = 32, 1024


def sets_of(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    data, offsets = common.byte_column(column)
    for a, b in common.row_slices(offsets):
        yield from windows(*words(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]), b - a, k)


def node_of(shingles: np.ndarray) -> int:
    """The number of a set; 0 is the empty one."""
    if not len(shingles):
        return 0
    return int(mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + U(len(shingles)))[0].view(np.int64)) or 1


def counts(shingles: np.ndarray) -> bytes:
    """The point of a set: how many shingles each of its groups has, one to two groups per shingle; the first byte tells the width of a count.

    Groups are ranges of the hash and powers of two in number, so that points of two sizes are compared after adding up neighbours. Nearly all
    groups then hold one shingle at most, and the bound is close to the overlap itself.
    """
    groups = min(max(LEAST_GROUPS, 1 << len(shingles).bit_length()), MOST_GROUPS)
    found = np.bincount((shingles >> U(64 - groups.bit_length() + 1)).astype(np.int64), minlength=groups)
    width = 1 if found.max(initial=0) < 0x100 else 4
    return bytes([width]) + found.astype(f"<u{width}").tobytes()


def point(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, f"<u{stored[0]}", offset=1)


def coarsest(points: list[np.ndarray]) -> np.ndarray:
    """Points as one matrix, with as many groups as the smallest has."""
    groups = min(map(len, points))
    return np.stack([p.reshape(groups, -1).sum(1, dtype=np.uint32) for p in points])


def cuts(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of the groups of a set: of its octave's cut and, if a partner can be in the next octave, of that one's.

    A cut of m groups is sure to work for a set with more than n (1 - t) / t filled groups; a set with fewer enters cuts of 2 m, 4 m, ...
    as well, up to the first that works. Of two linked sets the one that works earlier then has an untouched group in a cut both entered.
    """
    n, out = len(shingles), []
    most = n * (den - num) // num  # differing shingles of a linked pair
    octave = n.bit_length() - 1
    salted = mix(shingles)
    high = shingles >> U(32)
    for o in (octave, octave + 1):
        if o > octave and n * den < num << o:
            break
        m = (((2 << o) * (den - num) * 8) // (num * 7)) + 1
        while True:
            alone = m > 64 * n
            group = shingles if alone else (high * U(m)) >> U(32)
            start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            out.append(mix(np.add.reduceat(salted, start) + mix(group[start] + U(m << 8) + U(o))))
            if alone or len(start) > most:
                break
            m *= 2
    return np.concatenate(out)


def described(docs: DataFrame, k: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, node; stored."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), node_of(s)) for s in sets_of(batch.column("text"), k)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[i] for x in found], pa.int64()) for i in (0, 1))], ["doc_id", "n_shingles", "node"])

    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_of(text).alias("text"))
    return common.stored(t.mapInArrow(task, "doc_id long, n_shingles long, node long"), "shingle-sets")


def meetings(docs: DataFrame, k: int, num: int, den: int, text: str, part_bytes: int = 8 << 20) -> DataFrame:
    """key, node, leader, members: the nodes that share a group, each with the smallest of them; the leader's own row is left out. Stored."""
    buckets = common.parts_for(docs, text, part_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes, seen = [], [], set()
            for s in sets_of(batch.column("text"), k):
                node = node_of(s)
                if node and node not in seen:
                    seen.add(node)
                    keys.append(cuts(s, num, den))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
            if keys:
                key, node = np.concatenate(keys), np.concatenate(nodes).view(np.uint64)
                by = np.argsort(key)
                yield from rounds.packets(0, key[by], [(node[by], 8)], buckets).to_batches()

    def meet(bucket: tuple, t: pa.Table) -> pa.Table:
        _, (key, node) = rounds.gathered(t, [8, 8])
        node = node.view(np.int64)
        by = np.lexsort((node, key))
        key, node = key[by], node[by]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])  # equal sets came from several batches
        key, node = key[fresh], node[fresh]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        leader, members = np.repeat(node[start], size), np.repeat(size, size)
        keep = node != leader
        return pa.table({"key": pa.array(key[keep].view(np.int64)), "node": pa.array(node[keep]), "leader": pa.array(leader[keep]), "members": pa.array(members[keep])})

    sent = docs.select(common.text_of(text).alias("text")).mapInArrow(ask, rounds.PACKET)
    return common.stored(sent.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(meet, "key long, node long, leader long, members long"), "meetings")


def points(docs: DataFrame, nodes: DataFrame, k: int, text: str) -> DataFrame:
    """node, n, counts, text: one text for each of `nodes`; stored."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first: dict[int, tuple] = {}
            for i, s in enumerate(sets_of(batch.column("text"), k)):
                first.setdefault(node_of(s), (i, len(s), counts(s)))
            first.pop(0, None)
            rows = list(first.values())
            yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()),
                                              batch.column("text").take(pa.array([r[0] for r in rows], pa.int64()))], ["node", "n", "counts", "text"])

    t = docs.select(common.text_of(text).alias("text")).mapInArrow(task, "node long, n long, counts binary, text string")
    return common.stored(t.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "points")


def _points(column: pa.Array) -> list[np.ndarray]:
    return [point(x) for x in column.to_pylist()]


def bounded(pairs: DataFrame, at: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs u, v whose counts leave the threshold within reach."""
    p = at.select("node", "n", "counts")
    both = (pairs.join(p.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.col("counts").alias("cu")), "u")
            .join(p.select(F.col("node").alias("v"), F.col("n").alias("nv"), F.col("counts").alias("cv")), "v"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                most = np.array([int(np.minimum(*coarsest([x, y])).sum()) for x, y in zip(_points(batch.column("cu")), _points(batch.column("cv")), strict=True)])
                ok = most * (num + den) >= num * (batch.column("nu").to_numpy() + batch.column("nv").to_numpy())
                yield batch.select(["u", "v"]).filter(pa.array(ok))

    return both.select("u", "v", "nu", "nv", "cu", "cv").mapInArrow(task, "u long, v long")


def verified(pairs: DataFrame, at: DataFrame, k: int, num: int, den: int, bound: bool = True) -> DataFrame:
    """The pairs u, v that link, by their whole sets; stored. `bound` false: the pairs have met the bound already."""
    t = at.select("node", "text")
    both = ((bounded(pairs, at, num, den) if bound else pairs).join(t.select(F.col("node").alias("u"), F.col("text").alias("x")), "u")
            .join(t.select(F.col("node").alias("v"), F.col("text").alias("y")), "v"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, np.empty(0, np.uint64)
        for batch in batches:
            ok = []
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for left, v, y in zip(sets_of(part.column("x"), k), part.column("v").to_pylist(), part.column("y"), strict=True):
                    if v != last:
                        last, right = v, next(sets_of(pa.array([y.as_py()], pa.string()), k))
                    same = np.searchsorted(right, left)
                    both = int((right[np.minimum(same, len(right) - 1)] == left).sum())
                    ok.append(both * den >= num * (len(left) + len(right) - both))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return common.stored(both.select("u", "v", "x", "y").mapInArrow(task, "u long, v long"), "set-links")


def tree_pairs(n: np.ndarray, count: np.ndarray, root: np.ndarray, num: int, den: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of different roots (and different sides) whose counts leave the threshold within reach, by a join of the leaves of a packed R-tree.

    The tree holds the points with few groups, which is enough to part most of them; what is left is bounded again with all groups.
    """
    by = np.lexsort((n, root))
    by = by[np.argsort(n[by], kind="stable")]
    n, root, fine = n[by], root[by], count[by]
    side = side if side is None else side[by]
    count = fine.reshape(len(fine), LEAST_GROUPS, -1).sum(2, dtype=np.int32)
    edges = np.arange(0, len(n), LEAF)
    top = np.maximum.reduceat(count, edges, axis=0)
    least, most = np.minimum.reduceat(n, edges), np.maximum.reduceat(n, edges)
    first, last = np.minimum.reduceat(root, edges), np.maximum.reduceat(root, edges)
    us, vs = [], []
    for i, a in enumerate(edges.tolist()):
        # leaves are in order of size: those within reach of leaf i from i on; boxes first
        far = int(np.searchsorted(least, most[i] * den // num, "right"))
        box = np.minimum(top[i: far], top[i]).sum(1) * (num + den) >= num * (least[i: far] + least[i])
        box &= ~((first[i: far] == last[i]) & (last[i: far] == first[i]))  # two leaves of one root have nothing to find
        rows = np.arange(a, min(a + LEAF, len(n)))
        for j in (np.flatnonzero(box) + i).tolist():
            cols = np.arange(edges[j], min(edges[j] + LEAF, len(n)))
            over = np.minimum(count[rows][:, None], count[cols][None]).sum(2) * (num + den) >= num * (n[rows][:, None] + n[cols][None])
            over &= (root[rows][:, None] != root[cols][None]) & (rows[:, None] < cols[None])
            if side is not None:
                over &= side[rows][:, None] != side[cols][None]
            x, y = np.nonzero(over)
            x, y = rows[x], cols[y]
            if len(x) and fine.shape[1] > LEAST_GROUPS:
                keep = np.minimum(fine[x], fine[y]).sum(1, dtype=np.int64) * (num + den) >= num * (n[x] + n[y])
                x, y = x[keep], y[keep]
            us.append(by[x])
            vs.append(by[y])
    return (np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, np.int64),) * 2


def _rooted(nodes: DataFrame, roots: DataFrame, name: str, out: str) -> DataFrame:
    r = roots.select(F.col("node").alias(name), F.col("component_id").alias(out))
    return nodes.join(r, name, "left").withColumn(out, F.coalesce(out, name))


def mixed(held: DataFrame) -> DataFrame:
    """The members of the groups of `held` (key, node, root) with several roots, with the root that most members have (main) and how many members
    there are (size). What comes from here is not worked on again."""
    if "main" in held.columns:
        return held
    per = held.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    found = per.groupBy("key").agg(F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.sum("c").alias("size"))
    return held.join(found.where("roots > 1").select("key", F.col("top.root").alias("main"), "size"), "key")


def delegated(held: DataFrame) -> DataFrame:
    """u, v: every member outside the largest component of its group with one member of it, another one in each group."""
    t = mixed(held)
    one = t.where("root = main").groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("one"))
    rest = t.where("root <> main").join(one, "key")
    return rest.select(F.greatest("node", "one").alias("u"), F.least("node", "one").alias("v")).distinct()


def blocks(held: DataFrame, at: DataFrame, block: int) -> DataFrame:
    """key, block, node, n, root: the members of mixed groups of more than `block`, at most `block` to a block; stored. A row without a node closes
    a block, with least (n) and most (n_most) size, least (root) and last root (root_most) and the upper corner of its points."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, open_at, held = TaskContext.get().partitionId() << 32, None, 0
        low = high = first = last = 0
        corner = np.zeros(LEAST_GROUPS, np.int64)

        def closed() -> pa.RecordBatch:
            row = (open_at[0], number, None, low, high, first, last, corner.tolist())
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, kinds, strict=True)], schema=kinds)

        kinds = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("n_most", pa.int64()),
                           ("root", pa.int64()), ("root_most", pa.int64()), ("corner", pa.list_(pa.int64()))])
        for batch in batches:
            if not batch.num_rows:
                continue
            key, main, n, root = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "inner", "n", "root"))
            edge = np.flatnonzero((key[1:] != key[:-1]) | (main[1:] != main[:-1])) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(key)], strict=True):
                while a < b:
                    mine = (int(key[a]), bool(main[a]))
                    if open_at is not None and (open_at != mine or held == block):
                        yield closed()
                        number, open_at, held = number + 1, None, 0
                    c = min(b, a + block - held)
                    top = coarsest([p.reshape(LEAST_GROUPS, -1).sum(1, dtype=np.uint32) for p in _points(batch.column("counts").slice(a, c - a))]).max(0)
                    of_n, of_root = (int(n[a:c].min()), int(n[a:c].max())), (int(root[a:c].min()), int(root[a:c].max()))
                    if open_at is None:
                        open_at, corner, (low, high), (first, last) = mine, top.astype(np.int64), of_n, of_root
                    else:
                        corner = np.maximum(corner, top)
                        low, high, first, last = min(low, of_n[0]), max(high, of_n[1]), min(first, of_root[0]), max(last, of_root[1])
                    m, part = c - a, batch.slice(a, c - a)
                    yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(np.full(m, number)), part.column("node"), part.column("n"), part.column("n"),
                                                      part.column("root"), part.column("root"),
                                                      pa.nulls(m, pa.list_(pa.int64()))], schema=kinds)
                    held, a = held + m, c
        if open_at is not None:
            yield closed()

    t = mixed(held).where(F.col("size") > block).select("key", "node", "root", (F.col("root") == F.col("main")).alias("inner")).join(at.select("node", "n", "counts"), "node")
    # a group of any size is spread over the tasks: its members are dealt in ranges of size
    order = ("key", "inner", "n", "node")
    t = t.select("key", "inner", "n", "node", "root", "counts").repartitionByRange(*order).sortWithinPartitions(*order)
    return common.stored(t.mapInArrow(task, "key long, block long, node long, n long, n_most long, root long, root_most long, corner array<long>"), "blocks")


def block_pairs(cut: DataFrame, num: int, den: int) -> DataFrame:
    """key, a, b and the members of both blocks (`block` tells which), for the blocks of one group that can hold a pair of different roots."""
    closed = cut.where("node is null")
    x, y = (closed.select("key", *(F.col(c).alias(f"{c}_{i}") for c in ("block", "n", "n_most", "root", "root_most", "corner"))) for i in "xy")
    both = x.join(y, "key").where("block_x <= block_y").where((F.col("n_most_x") * den >= F.col("n_y") * num) & (F.col("n_most_y") * den >= F.col("n_x") * num))
    both = both.where("not (root_x = root_most_x and root_y = root_most_y and root_x = root_y)")
    most = F.aggregate(F.zip_with("corner_x", "corner_y", lambda p, q: F.least(p, q)), F.lit(0).cast("long"), lambda s, c: s + c)
    pairs = both.where(most * (num + den) >= (F.col("n_x") + F.col("n_y")) * num).select("key", F.col("block_x").alias("a"), F.col("block_y").alias("b"))
    sides = pairs.select("key", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    members = sides.join(cut.where("node is not null").select("block", "node", "root"), "block")
    return members.select("key", "a", "b", "block", "node", "root")


def searched(held: DataFrame, at: DataFrame, num: int, den: int, block: int = BLOCK) -> DataFrame:
    """u, v: the pairs of different roots inside a group of `held` (key, node, root) that the counts leave; a task holds two blocks at a time."""
    def search(key: tuple, t: pa.Table) -> pa.Table:
        node, n, root, side = (t.column(c).to_numpy() for c in ("node", "n", "root", "block"))
        one = key[1].as_py() == key[2].as_py()
        u, v = tree_pairs(n, coarsest(_points(t.column("counts"))), root, num, den, None if one else side)
        return pa.table({"u": pa.array(np.maximum(node[u], node[v])), "v": pa.array(np.minimum(node[u], node[v]))})

    # a group that fits one block is one
    small, no = mixed(held).where(F.col("size") <= block), F.lit(-1).cast("long")
    small = small.select("key", no.alias("a"), no.alias("b"), no.alias("block"), "node", "root")
    both = small.unionByName(block_pairs(blocks(held, at, block), num, den)).join(at.select("node", "n", "counts"), "node")
    return both.groupBy("key", "a", "b").applyInArrow(search, "u long, v long").distinct()


def set_components(docs: DataFrame, k: int, num: int, den: int, text: str) -> DataFrame:
    """node, component_id of every set that links with a set of a smaller number."""
    met = meetings(docs, k, num, den, text)
    stars = common.stored(met.select("node", "leader").distinct(), "stars")
    at = points(docs, stars.select("node").union(stars.select(F.col("leader").alias("node"))).distinct(), k, text)
    # first each node against the smallest leader it has, then every leader that is not of its component yet
    first = stars.groupBy("node").agg(F.min("leader").alias("v")).select(F.col("node").alias("u"), "v")
    roots = components(verified(first, at, k, num, den))
    odd = _rooted(_rooted(stars, roots, "node", "ru"), roots, "leader", "rv").where("ru <> rv").select(F.col("node").alias("u"), F.col("leader").alias("v"))
    roots = components(verified(odd.join(first, ["u", "v"], "left_anti"), at, k, num, den), roots)
    # groups with members still apart: search them for the pairs that no leader stands for
    odd = common.stored(_rooted(_rooted(stars, roots, "node", "ru"), roots, "leader", "rv").where("ru <> rv").select("node", "leader"), "apart")
    groups = met.where("members > 2").join(odd, ["node", "leader"], "left_semi").select("key").distinct()
    inside = met.where("members > 2").join(groups, "key", "left_semi").select("key", "node")
    # groups of the same members hold the same pairs: one of them is searched
    lists = inside.groupBy("key").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("what"), F.count(F.lit(1)).alias("n"))
    # stored, and so is what a round works on: the queries that follow would carry the plan of all this at each place that reads it
    inside = common.stored(inside.join(lists.groupBy("what", "n").agg(F.min("key").alias("key")), "key", "left_semi"), "inside")
    # what one member of a component stands for is joined first; the search is left with what is really apart
    for bound in (True, False):
        held, n = common.counted(mixed(_rooted(inside, roots, "node", "root")), "mixed")
        if not n:
            break
        across = delegated(held) if bound else searched(held, at, num, den)
        roots = components(verified(across, at, k, num, den, bound), roots)
    return roots


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each component: one of those with the smallest id (a null id is the largest), and of rows of that id one with the smallest
    set. Rows that share an id and nothing else are no copies and all stay, as do rows without words."""
    sets = described(docs, k, doc_id, text)
    named = _rooted(sets.where("node <> 0"), set_components(docs, k, num, den, text), "node", "root")
    per = named.groupBy("root", "doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
    least = per.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "n")).alias("k"))
    least = common.stored(least.select(F.col("k.doc_id").alias("_kept_id"), F.col("k.node").alias("_kept_node"), F.col("k.n").alias("_kept_rows")), "kept")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([node_of(s) for s in sets_of(batch.column(text), k)], pa.int64())], [*batch.schema.names, "_set_node"])

    marked = docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField("_set_node", T.LongType())]))
    held = marked.join(least, (F.col("_set_node") == F.col("_kept_node")) & F.col(doc_id).cast("long").eqNullSafe(F.col("_kept_id")), "left")
    held = common.stored(held.where("_set_node = 0 or _kept_rows is not null"), "kept-rows")
    # rows equal in id and set are few: only they are sorted out
    once = held.where("_set_node = 0 or _kept_rows = 1").select(*docs.columns)
    return once.unionByName(held.where("_kept_rows > 1").dropDuplicates(["_kept_node"]).select(*docs.columns))


def near_duplicates(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id per document: linked are pairs with den * intersection >= num * union."""
    sets = described(docs, k, doc_id, text)
    named = _rooted(sets, set_components(docs, k, num, den, text), "node", "root")
    names = named.where("node <> 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = named.where("node <> 0").join(names, "root").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(sets.where("node = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
