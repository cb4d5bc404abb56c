"""Near-duplicate vectors by cover trees and dual traversal.

1. Equal vectors collapse to one weighted point.
2. A bounded sample gives at most CELLS centres, every point joins its nearest one, and
   the cells' covering radii are measured over all points.  Cells are dealt into blocks of
   about BLOCK points, so a crowded cell is many blocks.
3. Two blocks meet unless their cells' centres lie further apart than both covering radii
   and the search distance.
4. In a task each block becomes a cover tree: nested levels with halving radii, each node
   with the true covering radius of what is below it.  The two trees are traversed
   together from the top, level by level; a pair of nodes is dropped by the same bound, and
   points of the last pairs are compared in double precision.

A task returns, for each point with links, their number and the smallest point it is
connected to there - never the pairs.  The bounds are exact, so no pair is missed.  In
data without cluster structure they cannot cut much, and work grows with the square of the
number of different vectors; that is the nature of exact search there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.resolve import connected_components

from .common import bucket_of, stored

COSINE = 0.95
CELLS = 8
SAMPLE = 2048            # points, about, from which the centres are chosen
BLOCK = 8192
RADII = (1.25, 0.625, 0.3125)
SLACK = 1e-5             # bounds are computed in single precision


def unit_vectors(column) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    # by a power of two first, which rounds nothing: squares neither over- nor underflow
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distance(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ centre)))


class Tree:
    """Levels of nodes; a node is a point with a covering radius and children below."""

    def __init__(self, x: np.ndarray, radii=RADII):
        self.x, self.x32 = x, x.astype(np.float32)
        self.centres, self.radius, self.children = [], [], []
        groups = [np.arange(len(x))]
        for r in radii:
            centres, members, kids = [], [], []
            for group in groups:
                first = len(centres)
                while len(group):
                    d = distance(x[group], x[group[0]])
                    near = d <= r
                    near[0] = True
                    centres.append(int(group[0]))
                    members.append(group[near])
                    group = group[~near]
                kids.append(np.arange(first, len(centres)))
            self.centres.append(np.array(centres, np.int64))
            self.children.append(kids)
            self.radius.append(np.array([distance(x[m], x[c]).max() if len(m) > 1 else 0.0
                                         for c, m in zip(centres, members)], np.float32))
            groups = members
        self.members = groups


def dual(a: Tree, b: Tree, reach: float) -> Iterator[tuple[int, np.ndarray]]:
    """(node of a's last level, nodes of b's) that may hold points within `reach`."""
    pairs = {0: np.zeros(1, np.int64)}
    for level in range(len(a.centres)):
        below: dict = {}
        for node, others in pairs.items():
            mine = a.children[level][node]
            theirs = (np.concatenate([b.children[level][o] for o in others]) if len(others) < len(b.children[level])
                      else np.arange(len(b.centres[level])))
            dots = a.x32[a.centres[level][mine]] @ b.x32[b.centres[level][theirs]].T
            own, other = a.radius[level][mine], b.radius[level][theirs]
            # first by the largest radius of the others, one bound a row; then pair by pair
            widest = own + other.max() + reach + SLACK
            row, col = np.nonzero(dots >= (1 - np.minimum(widest, 2) ** 2 / 2 - SLACK)[:, None])
            bound = np.minimum(own[row] + other[col] + reach + SLACK, 2)
            good = dots[row, col] >= 1 - bound ** 2 / 2 - SLACK
            row, col = row[good], col[good]
            cut = np.searchsorted(row, np.arange(len(mine) + 1))
            for k in range(len(mine)):
                if cut[k] < cut[k + 1]:
                    below[int(mine[k])] = theirs[col[cut[k]:cut[k + 1]]]
        pairs = below
    yield from pairs.items()


def links_between(a: Tree, b: Tree, weight_a, weight_b, cosine: float):
    """(links of a's points, links of b's points, labels): labels join the points of both
    trees (a's first) that links connect.  For a tree with itself pass it twice."""
    same = a is b
    reach = float(np.sqrt(2 - 2 * cosine))
    n = len(a.x)
    links_a, links_b = np.zeros(n, np.int64), np.zeros(len(b.x), np.int64)
    root = list(range(n + (0 if same else len(b.x))))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for node, others in dual(a, b, reach):
        left = a.members[node]
        right = np.concatenate([b.members[o] for o in others])
        if same and len(left) == 1 and len(right) == 1:
            continue
        for at in range(0, len(left), 2048):
            part = left[at:at + 2048]
            hit = a.x[part] @ b.x[right].T >= cosine
            if same:
                hit &= part[:, None] != right[None, :]
            if not hit.any():
                continue
            links_a[part] += hit @ weight_b[right]
            if not same:
                links_b[right] += weight_a[part] @ hit
            shift = 0 if same else n
            label_l = np.array([find(i) for i in part.tolist()])
            label_r = np.array([find(i + shift) for i in right.tolist()])
            top = len(root)
            while True:                       # smallest label among linked points, until stable
                new_l = np.minimum(label_l, np.where(hit, label_r[None, :], top).min(axis=1))
                new_r = np.minimum(label_r, np.where(hit, new_l[:, None], top).min(axis=0))
                if (new_l == label_l).all() and (new_r == label_r).all():
                    break
                label_l, label_r = new_l, new_r
            for points, labels in ((part, label_l), (right + shift, label_r)):
                for i, j in zip(points.tolist(), labels.tolist()):
                    i, j = find(i), find(j)
                    root[max(i, j)] = min(i, j)
    return links_a, links_b, np.array([find(i) for i in range(len(root))])


def centres_of(sample: np.ndarray, most: int = CELLS) -> np.ndarray:
    """Farthest-first centres, whose prefixes cover with falling radii."""
    chosen = [0]
    far = distance(sample, sample[0])
    while len(chosen) < most and far.max() > RADII[-1]:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distance(sample, sample[chosen[-1]]))
    return sample[chosen]


def _compare(cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["side", "id"], kind="stable")
        first = group["side"].to_numpy() == group["side"].iloc[0]
        x, ids, weight = unit_vectors(group["x"]), group["id"].to_numpy(), group["weight"].to_numpy()
        if group["same"].iloc[0]:
            tree = Tree(x)
            links, _, label = links_between(tree, tree, weight, weight, cosine)
        elif first.all():
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        else:
            a, b, label = links_between(Tree(x[first]), Tree(x[~first]), weight[first], weight[~first], cosine)
            links = np.concatenate([a, b])
        return pd.DataFrame({"id": ids, "links": links, "root": ids[label]})[links > 0]
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null, NaN or infinite components link with
    nothing, nor do null ids (component_id null, kept).  Vectors of different length compare
    as if the shorter one went on with zeros.  Rows that share an id are that many vectors;
    each row reports the links of its own.  An empty table gives no rows.
    """
    x = F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double"))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    nonzero = F.exists("x", lambda v: v != 0)
    valid = F.coalesce(finite & nonzero & F.col("id").isNotNull(), F.lit(False))
    rows = rows.withColumn("valid", valid).withColumn("key", F.when(valid, F.col("x")))
    points = stored(rows.filter("valid").groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("weight")).withColumnRenamed("key", "x"))
    n, width = points.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    classes = points.select(F.col("x").alias("key"), F.col("id").alias("point"))
    points = points.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("x"))))
    share = min(1_000_000, int(1_000_000 * SAMPLE / n) + 1)
    sample = points.filter(bucket_of(F.col("id"), 1_000_000) < share).select("x").orderBy("x").limit(2 * SAMPLE).toPandas()
    if not len(sample):
        sample = points.select("x").orderBy("x").limit(1).toPandas()
    centres = centres_of(unit_vectors(sample["x"]))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                far = np.sqrt(np.maximum(0.0, 2 - 2 * (unit_vectors(batch["x"]) @ centres.T)))
                batch["cell"] = far.argmin(axis=1).astype(np.int32)
                batch["far"] = far.min(axis=1)
                yield batch

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    placed = stored(points.mapInPandas(place, f"{kind}, cell int, far double"))
    cells = placed.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).orderBy("cell").collect()
    blocks = {r["cell"]: -(-r["n"] // BLOCK) for r in cells}                     # at most CELLS rows
    reach = float(np.sqrt(2 - 2 * cosine))
    pairs = []
    for p in cells:
        for q in cells:
            gap = distance(centres[[p["cell"]]], centres[q["cell"]])[0]
            if p["cell"] == q["cell"] or gap <= p["radius"] + q["radius"] + reach + SLACK:
                pairs.append((p["cell"], q["cell"], blocks[p["cell"]], blocks[q["cell"]]))
    spark = vectors.sparkSession
    meets = F.broadcast(spark.createDataFrame(pairs, "cell int, other int, own_blocks long, other_blocks long"))
    keyed = (placed.join(meets, "cell")
             .withColumn("block", bucket_of(F.col("id"), F.col("own_blocks")))
             .withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_blocks") - 1))))
    mine, theirs = F.struct("cell", "block"), F.struct(F.col("other").alias("cell"), F.col("other_block").alias("block"))
    keyed = (keyed.withColumn("low", F.least(mine, theirs)).withColumn("high", F.greatest(mine, theirs))
             .withColumn("side", (mine != F.col("low")).cast("int")).withColumn("same", F.col("low") == F.col("high")))
    found = stored(keyed.select("low", "high", "side", "same", "id", "weight", "x").groupBy("low", "high")
                   .applyInPandas(_compare(cosine), "id long, links long, root long"))
    parts = connected_components(found.select(F.col("id").alias("src"), F.col("root").alias("dst")))
    per_point = found.groupBy(F.col("id").alias("_f")).agg(F.sum("links").alias("links"))
    info = (points.select(F.col("id").alias("point"), "weight")
            .join(per_point, F.col("point") == F.col("_f"), "left")
            .join(parts, F.col("point") == F.col("vertex"), "left")
            .select("point", "weight", F.coalesce("links", F.lit(0)).alias("links"),
                    F.coalesce("component", "point").alias("root")))
    known = classes.join(info, "point").select(F.col("key").alias("_key"), "weight", "links", "root")
    out = rows.join(known, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("_key").isNotNull(), F.col("root")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("vec_id"),
        F.when(F.col("_key").isNotNull(), F.col("links") + F.col("weight") - 1).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
