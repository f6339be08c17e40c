"""Embedding near-duplicates: cover trees, traversed in pairs, for all pairs above a cosine within a label.

Equal vectors of a label are one class with a least id and a count. On unit vectors a cosine is a distance, so
balls bound it. The tree's upper levels are built across tasks: a node with more than about ``block`` classes takes
centres among its own classes, picked by hash and thinned to half its radius (less, if one centre would be left),
every class goes to the nearest, and the greatest distance is the child's covering radius. A node whose members
are all within the threshold of each other is linked as a whole, by its total, and not opened. Pairs of nodes are
expanded level by level: only children of pairs that their covering radii don't keep apart are met with each other.
Leaves are packed into blocks, one row each, and every pair of blocks that is left is one task.

A task builds a cover tree over each block: nested levels of centres whose radii halve, every centre covering its
children. Both trees are traversed together. A pair of tree nodes that the triangle inequality keeps apart is
pruned, one whose members are all within the threshold is taken as a whole, others are opened down to the leaves,
where cosines are computed in double precision. So the pairs are exact. A task returns one row per class: how
many vectors it is linked with, and the least class of its links; pairs are never rows.

Vectors without any clusters lie about equally far from each other, so no radius keeps blocks of them apart, and
the comparisons of a label then grow with the square of its classes. Leaves that no centres divide are cut by hash;
that changes what can be pruned, never the result.

Edge cases: a null label, and vectors that are null, empty, zero, of another length than their partner's, or hold
a null or non-finite component, link with nothing; rows that repeat are vectors of their own; a null id can't name
a component but is linked; an empty table gives no rows. Columns other than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.components import components
from refrain.llm.store import stored

COSINE = 0.93
BLOCK = 2048
BLOCK_BYTES = 1 << 20  # of the vectors in a block: long vectors make smaller blocks
GROUP_BYTES = 1 << 24  # of the vectors that one task assigns to the centres of their node
CENTRES = (8, 64)  # centres of a node, about: at least, at most
LEVELS = 24
LEAF = 24
CHUNK = 512
SLACK = 1e-7  # distances decide only beyond rounding; cosines decide the rest


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _distance(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


def net(x: np.ndarray, apart: float) -> list[int]:
    """Rows of ``x``, in order, of which none lies within ``apart`` of one before; every row is that near to one."""
    near, free, chosen = _distance(x @ x.T) <= apart, np.ones(len(x), bool), []
    for k in range(len(x)):
        if free[k]:
            chosen.append(k)
            free &= ~near[k]
    return chosen


class Node:
    """A node of a cover tree: centre, covering radius, members; children once it is opened."""

    __slots__ = ("centre", "kids", "members", "radius")

    def __init__(self, members: np.ndarray, centre: int, radius: float) -> None:
        self.centre, self.members, self.radius, self.kids = centre, members, radius, None

    @property
    def leaf(self) -> bool:
        return len(self.members) <= LEAF or self.radius <= SLACK

    def children(self, x: np.ndarray) -> list[Node]:
        """Nodes of at most half the radius, least radius first."""
        if self.kids is None:
            self.kids, left = [], self.members
            while len(left):  # centres among the next members, which take all that they cover
                some = left[:CHUNK]
                centres = some[net(x[some], self.radius / 2)]
                dots = x[left] @ x[centres].T
                best = dots.argmax(1)
                d = _distance(dots[np.arange(len(left)), best])
                near = d <= self.radius / 2
                near[: len(some)] = True
                order = np.flatnonzero(near)[np.argsort(best[near], kind="stable")]
                cuts = np.flatnonzero(np.diff(best[order])) + 1
                for part in np.split(order, cuts):
                    self.kids.append(Node(left[part], int(centres[best[part[0]]]), float(d[part].max())))
                left = left[~near]
            self.kids.sort(key=lambda node: node.radius)
        return self.kids


def cover_tree(x: np.ndarray, members: np.ndarray) -> Node:
    return Node(members, int(members[0]), float(_distance(x[members] @ x[members[0]]).max()))


def _met(x: np.ndarray, p: list[Node], q: list[Node], reach: float) -> np.ndarray:
    """Which nodes of ``p`` the covering radii don't keep apart from which nodes of ``q``."""
    a, b = (np.array([n.radius for n in side]) for side in (p, q))
    gap = _distance(x[[n.centre for n in p]] @ x[[n.centre for n in q]].T)
    met = gap <= reach + SLACK + a.max() + b.max()
    i, j = np.nonzero(met)
    met[i, j] = gap[i, j] <= reach + SLACK + a[i] + b[j]
    return met


def _members(nodes: list[Node], which: np.ndarray) -> np.ndarray:
    return np.concatenate([nodes[k].members for k in which])


def dual_links(x: np.ndarray, a: np.ndarray, b: np.ndarray | None, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Blocks of links between members ``a`` and ``b`` of unit vectors ``x`` (``b`` None: within ``a``).

    Yields (rows, columns, matrix): a boolean matrix of linked pairs, or None if all pairs of the block are linked.
    A block of members with themselves has rows is columns. No pair is in two blocks, every linked pair is in one.
    Children are met in rectangles; leaves that meet in a rectangle are compared together.
    """
    reach = float(np.sqrt(2 - 2 * cosine))
    first = cover_tree(x, a)
    stack = [(first, first if b is None else cover_tree(x, b))]
    while stack:
        p, q = stack.pop()
        if p is q:
            if len(p.members) == 1:
                continue
            if 2 * p.radius <= reach - SLACK:
                yield p.members, p.members, None
                continue
            if p.leaf:
                yield p.members, p.members, x[p.members] @ x[p.members].T >= cosine
                continue
            rows = cols = p.children(x)
        else:
            gap = float(_distance(x[p.centre] @ x[q.centre]))
            if gap - p.radius - q.radius > reach + SLACK:
                continue
            if gap + p.radius + q.radius <= reach - SLACK:
                yield p.members, q.members, None
                continue
            if p.leaf and q.leaf:
                yield p.members, q.members, x[p.members] @ x[q.members].T >= cosine
                continue
            rows = [p] if p.leaf or (not q.leaf and p.radius < q.radius / 2) else p.children(x)
            cols = [q] if q.leaf or (not p.leaf and q.radius < p.radius / 2) else q.children(x)
        for i in range(0, len(rows), CHUNK):
            for j in range(i if p is q else 0, len(cols), CHUNK):
                some, others = rows[i : i + CHUNK], cols[j : j + CHUNK]
                met, within = _met(x, some, others, reach), p is q and i == j
                if within:
                    met = np.triu(met, 1)
                low = np.outer([n.leaf for n in some], [n.leaf for n in others])
                stack += [(some[k], others[m]) for k, m in np.argwhere(met & ~low)]
                pairs = met & low
                at, to = np.flatnonzero(pairs.any(1)), np.flatnonzero(pairs.any(0))
                if within:
                    at = np.union1d(at, to)
                    alone = np.setdiff1d(np.arange(len(some)), at)
                    stack += [(some[k], some[k]) for k in alone]
                    if len(at):
                        own = _members(some, at)
                        yield own, own, x[own] @ x[own].T >= cosine
                elif len(at):
                    left, right = _members(some, at), _members(others, to)
                    yield left, right, x[left] @ x[right].T >= cosine


def _merge(root: np.ndarray, rows: np.ndarray) -> None:
    """Give ``rows`` and all that share a root with one of them the least of their roots."""
    found = np.unique(root[rows])
    if len(found) > 1:
        root[np.isin(root, found[1:])] = found[0]


def _links_of(part: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Weights of links and least linked class of every class of one pair of blocks (one row: of a block with itself)."""
    packs = list(part.itertuples())
    classes, copies = (np.concatenate([np.frombuffer(getattr(r, name), np.int64) for r in packs]) for name in ("classes", "copies"))
    x = np.concatenate([np.frombuffer(r.vectors).reshape(-1, r.length) for r in packs])
    cut, n = len(packs[0].classes) // 8, len(classes)
    links, root, weight = np.zeros(n, np.int64), np.argsort(np.argsort(classes)), copies.astype(float)
    for p, q, matrix in dual_links(x, np.arange(cut), np.arange(cut, n) if len(packs) > 1 else None, cosine):
        if matrix is None:
            links[p] += copies[q].sum()
            if p is q:
                links[p] -= copies[p]
            else:
                links[q] += copies[p].sum()
            _merge(root, np.concatenate([p, q]))
            continue
        if p is q:
            np.fill_diagonal(matrix, False)
        links[p] += (matrix @ weight[q]).astype(np.int64)
        if p is not q:
            links[q] += (weight[p] @ matrix).astype(np.int64)
        for i in np.flatnonzero(matrix.any(1)):
            _merge(root, np.append(q[matrix[i]], p[i]))
    return pd.DataFrame({"class": classes, "links": links, "least": np.sort(classes)[root]})[links > 0]


def _stack(vectors: pd.Series) -> np.ndarray:
    return unit(np.stack(vectors.to_numpy()).astype(np.float64))


def _thinned(part: pd.DataFrame) -> pd.DataFrame:
    """Centres of one node: at least half its radius apart, or a half of that, until there are two."""
    part = part.sort_values("class")
    x, apart, chosen = _stack(part["vector"]), float(part["radius"].iloc[0]) / 2, [0]
    while len(chosen) < 2 and apart > SLACK:
        chosen, apart = net(x, apart), apart / 2
    if len(chosen) < 2:
        chosen = []
    picked = part.iloc[chosen]
    return pd.DataFrame(
        {"parent": picked["node"], "ways": picked["ways"], "k": range(len(chosen)), "centre": [x[c].tolist() for c in chosen]}
    )


def _assigned(part: pd.DataFrame) -> pd.DataFrame:
    """Nearest centre of classes of one node; the centres are the rows that have a number."""
    centres = part[part["k"] >= 0].sort_values("k")
    part = part[part["k"] < 0]
    if not len(part):
        return part.assign(k=0, distance=0.0)[["node", "class", "copies", "vector", "k", "distance"]]
    dots = _stack(part["vector"]) @ _stack(centres["vector"]).T
    best = dots.argmax(1)
    found = part.assign(k=best, distance=_distance(dots[np.arange(len(part)), best]))
    return found[["node", "class", "copies", "vector", "k", "distance"]]


def _packed(part: pd.DataFrame) -> pd.DataFrame:
    """One block of classes as one row."""
    part = part.sort_values("class")
    x = _stack(part["vector"])
    whole = {"block": part["block"].iloc[:1], "length": x.shape[1], "vectors": x.tobytes()}
    return pd.DataFrame(whole | {name: part[column].to_numpy(np.int64).tobytes() for name, column in (("classes", "class"), ("copies", "copies"))})


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """id, n_links, component_id (the least id its links reach, itself included) of every row."""
    v = F.col("vector")
    good = F.coalesce(F.size(v) > 0, F.lit(False)) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    good = good & F.exists(v, lambda e: e != 0) & F.col("label").isNotNull()
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label")
    )
    usable = rows.filter(good)
    classes = usable.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "near-classes")
    reach = float(np.sqrt(2 - 2 * cosine))

    # Roots: one for each label and length of vectors. A unit vector is within 1 of the origin.
    length = F.size("vector").alias("length")
    roots = classes.groupBy("label", length).agg(F.count("*").alias("n"))
    roots = stored(roots.withColumn("node", F.monotonically_increasing_id().cast("string")), "near-roots")
    found_root = (F.col("c.label") == F.col("r.label")) & (F.size("c.vector") == F.col("r.length"))
    members = classes.alias("c").join(roots.alias("r"), found_root).select("r.node", "c.class", "c.copies", "c.vector")
    origin = F.array_repeat(F.lit(0.0), F.col("length")).alias("centre")
    nodes = roots.select(F.lit(None).cast("string").alias("parent"), "node", "n", "length", origin, F.lit(1.0).alias("radius"))
    settled, levels = [], [nodes]
    most = F.least(F.lit(block), F.greatest(F.lit(16), F.floor(F.lit(BLOCK_BYTES / 8) / F.col("length"))))
    whole = 2 * F.col("radius") <= reach - SLACK
    for level in range(LEVELS):
        large = nodes.filter((F.col("n") > most) & ~whole)
        if large.isEmpty():
            break
        wanted = F.least(F.greatest(2 * F.col("n") / most, F.lit(CENTRES[0])), F.lit(CENTRES[1]))
        ways = F.ceil(8 * F.col("length") * F.col("n") / GROUP_BYTES).cast("int")
        large = stored(large.select("node", "radius", (wanted / F.col("n")).alias("share"), ways.alias("ways")), "near-large")
        chance = F.pmod(F.xxhash64("class", F.lit(level)), F.lit(1 << 30)) / float(1 << 30)
        picked = members.join(large, "node").filter(chance < F.col("share")).select("node", "class", "vector", "radius", "ways")
        centres = stored(
            picked.groupBy("node").applyInPandas(_thinned, "parent string, ways int, k int, centre array<double>"), "near-centres"
        )
        opened = centres.select(F.col("parent").alias("node"), "ways").distinct()
        settled.append((level, members.join(opened, "node", "left_anti")))
        dealt = members.join(opened, "node").select(
            "node", F.pmod(F.xxhash64("class"), "ways").cast("int").alias("way"), "class", "copies", "vector", F.lit(-1).alias("k")
        )
        way = F.explode(F.sequence(F.lit(0), F.col("ways") - 1)).alias("way")
        spread = centres.select(
            F.col("parent").alias("node"), way, F.lit(-1).cast("long").alias("class"), F.lit(0).cast("long").alias("copies"),
            F.col("centre").alias("vector"), "k",
        )
        schema = "node string, class long, copies long, vector array<double>, k int, distance double"
        placed = dealt.unionByName(spread).groupBy("node", "way").applyInPandas(_assigned, schema)
        path = F.concat_ws("/", "parent", "k").alias("node")
        placed = placed.withColumnRenamed("node", "parent").select("parent", path, "class", "copies", "vector", "distance")
        placed = stored(placed, "near-placed")
        members = placed.select("node", "class", "copies", "vector")
        sizes = placed.groupBy("parent", "node").agg(F.count("*").alias("n"), F.max("distance").alias("radius"))
        nodes = sizes.join(centres.select(path, "centre"), "node")
        nodes = stored(nodes.select("parent", "node", "n", F.size("centre").alias("length"), "centre", "radius"), "near-nodes")
        levels.append(nodes)
    settled.append((len(levels), members))
    members = reduce(DataFrame.unionByName, [part for _, part in settled])

    # Pairs of nodes, level by level. A node that was not opened stands for itself on the next level.
    pairs = roots.select(F.col("node").alias("x"), F.col("node").alias("y"))
    reached = levels[0]
    for below in levels[1:]:
        stay = reached.join(below.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
        columns = ["node", "n", "length", "centre", "radius"]
        kids = stored(below.select("parent", *columns).unionByName(stay.select(F.col("node").alias("parent"), *columns)), "near-kids")
        apart = F.sqrt(F.aggregate(F.zip_with("p.centre", "q.centre", lambda s, t: (s - t) * (s - t)), F.lit(0.0), lambda s, t: s + t))
        meet = (F.col("p.node") == F.col("q.node")) | (apart - F.col("p.radius") - F.col("q.radius") <= reach + SLACK)
        once = (F.col("x") < F.col("y")) | (F.col("p.node") <= F.col("q.node"))
        met = pairs.join(kids.alias("p"), F.col("x") == F.col("p.parent")).join(kids.alias("q"), F.col("y") == F.col("q.parent"))
        met = met.filter(once & meet).select(
            F.least("p.node", "q.node").alias("x"), F.greatest("p.node", "q.node").alias("y")
        )
        pairs, reached = stored(met, "near-pairs"), kids.select(*columns)

    # Leaves in blocks. A leaf of near vectors is linked as a whole, so that its blocks meet those of other leaves only.
    leaves = stored(reached.select("node", F.ceil(F.col("n") / most).cast("int").alias("blocks"), whole.alias("whole")), "near-leaves")
    name = F.concat_ws("#", "node", F.pmod(F.xxhash64("class"), "blocks")).alias("block")
    members = stored(members.join(leaves, "node").select("node", name, "class", "copies", "vector", "whole"), "near-members")
    schema = "block string, length int, vectors binary, classes binary, copies binary"
    packs = stored(members.groupBy("block").applyInPandas(_packed, schema), "near-packs")
    number = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocks = leaves.select("node", number.alias("k"), "whole").withColumn("block", F.concat_ws("#", "node", "k"))
    facing = pairs.join(blocks.alias("p"), F.col("x") == F.col("p.node")).join(blocks.alias("q"), F.col("y") == F.col("q.node"))
    same = F.col("x") == F.col("y")
    facing = facing.filter(~same | (~F.col("p.whole") & (F.col("p.k") <= F.col("q.k"))))
    facing = stored(facing.select(F.col("p.block").alias("x"), F.col("q.block").alias("y")), "near-facing")
    sides = facing.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    work = sides.join(packs, "block").groupBy("x", "y")
    links = "class long, links long, least long"
    found = stored(work.applyInPandas(lambda part: _links_of(part, cosine), links), "near-links")
    near = members.filter("whole").select("node", "class", "copies")
    total = near.groupBy("node").agg(F.sum("copies").alias("weight"), F.min("class").alias("least"))
    total = stored(total, "near-totals")
    as_whole = near.join(total, "node").select("class", (F.col("weight") - F.col("copies")).alias("links"), "least").filter("links > 0")
    found = stored(found.unionByName(as_whole), "near-found")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("class").alias("a"), F.col("least").alias("b")), "near")
    least = reached.join(classes.select(F.col("class").alias("node"), "id"), "node").groupBy("component").agg(F.min("id").alias("component_id"))
    of_class = stored(
        classes.join(links, "class", "left")
        .join(reached.withColumnRenamed("node", "class"), "class", "left")
        .join(least, "component", "left")
        .select(
            "label", "vector", F.coalesce("component_id", "id").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "near-result",
    )
    return (
        rows.join(of_class, ["label", "vector"], "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
