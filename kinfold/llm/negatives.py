"""Hard negatives by Fagin's threshold algorithm.

Rows lie in blocks of bounded size; every block holds, per dimension, its rows in sorted
order.  For an anchor a block is read by sorted access - each list from the end that the
sign of the anchor's component favours, all lists to the same depth - and every row that
turns up is scored in whole by random access, in integers.  No row that is still unseen can
score more than the threshold, the sum of the anchor's components times the values at the
depth reached.  Reading stops as soon as the threshold is strictly below the k-th score of
every window the anchor still looks for, so ties are never cut.

A window is a range of scores with its k best rows.  First each anchor looks for its
positives among the rows of its label, then, one window per positive, for negatives among
the others.  The k best of each block meet in Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_of, stored

EVERY = 50               # rows whose id this divides are anchors
SHIFTED, LABELS = 7, 10  # rows whose id SHIFTED divides take the next label, modulo LABELS
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
BLOCK = 4096             # rows, and anchors, that meet in one task
DEPTH = 16               # depth of the first round; each further one goes twice as deep
HALF, LOW, HIGH = 100, 50, 95    # LOW * positive <= HALF * negative <= HIGH * positive


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label") -> DataFrame:
    """(id, label, x): the rows that take part, one per id, components floored to integers."""
    x = F.col("v")
    finite = (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).filter(finite)
    # Sums of products stay exact in 64 bits.
    fits = F.forall(x, lambda c: F.abs(c * SCALE) < F.sqrt(F.lit(2.0**62) / F.size(x)) - 1)
    label = F.when(F.col("id") % SHIFTED == 0, F.pmod(F.col("label") + 1, F.lit(LABELS))).otherwise(F.col("label"))
    rows = rows.filter(fits).select("id", label.alias("label"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))
    return rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")


class Lists:
    """The rows of a block with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], x[by_id]
        self.order = np.argsort(self.x, axis=0, kind="stable")          # (rows, dimensions)

    def best(self, anchor: np.ndarray, usable: np.ndarray, lows: np.ndarray, highs: np.ndarray,
             k: int) -> tuple[list[np.ndarray], int]:
        """Per window lows..highs the positions of the k best usable rows, ties to the smaller
        id; and how many rows were scored."""
        n, d = self.x.shape
        used = np.flatnonzero(anchor)                                   # other lists add nothing to a score
        falling = anchor[used] > 0
        seen = np.zeros(n, bool)
        scores = np.full(n, np.iinfo(np.int64).min)
        depth, step, scored = 0, DEPTH, 0
        while depth < n:
            to = min(n, depth + step)
            up = self.order[depth:to, used[~falling]]
            down = self.order[n - to:n - depth, used[falling]]
            fresh = np.zeros(n, bool)
            fresh[up.ravel()] = True
            fresh[down.ravel()] = True
            if not len(used):
                fresh[:] = True                                         # a zero anchor: all scores are 0
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh & usable)
            scores[rows] = self.x[rows] @ anchor
            scored += len(rows)
            depth, step = to, to
            if seen.all():
                break
            edge = np.where(falling, self.x[self.order[n - to, used], used], self.x[self.order[to - 1, used], used])
            threshold = int(edge @ anchor[used])
            if all(threshold < low or self._kth(scores, low, high, k) > threshold for low, high in zip(lows, highs)):
                break
        found = []
        for low, high in zip(lows, highs):
            at = np.flatnonzero((scores >= low) & (scores <= high) & usable & seen)
            found.append(at[np.argsort(-scores[at], kind="stable")[:k]])
        self.scores = scores
        return found, scored

    @staticmethod
    def _kth(scores: np.ndarray, low: int, high: int, k: int) -> int:
        inside = scores[(scores >= low) & (scores <= high)]
        return int(np.partition(inside, len(inside) - k)[-k]) if len(inside) >= k else np.iinfo(np.int64).min


FOUND = "anchor_id long, window_id long, found_id long, score long"
EVERYTHING = (-2**63 + 1, 2**63 - 1)


def _vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])
    return flat.astype(np.int64, copy=False).reshape(n, -1)


def _search(k: int, same: bool):
    """The rows and the anchors of one block, as a function of Arrow tables."""
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and anchors.num_rows:
            ids = rows["id"].to_numpy()
            lists = Lists(ids, _vectors(rows["x"], len(ids)))
            label = rows["label"].to_numpy()[np.argsort(ids, kind="stable")]
            vectors = _vectors(anchors["a_x"], anchors.num_rows)
            windows = anchors["a_windows"].to_pylist()
            for i, (anchor, own) in enumerate(zip(anchors["a_id"].to_pylist(), anchors["a_label"].to_pylist())):
                usable = (label == own) & (lists.ids != anchor) if same else label != own
                if not usable.any():
                    continue
                found, _ = lists.best(vectors[i], usable, [w["low"] for w in windows[i]], [w["high"] for w in windows[i]], k)
                for w, at in zip(windows[i], found):
                    out[0] += [anchor] * len(at)
                    out[1] += [w["id"]] * len(at)
                    out[2] += lists.ids[at].tolist()
                    out[3] += lists.scores[at].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], ["anchor_id", "window_id", "found_id", "score"])
    return run


def search(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """FOUND: the k best rows per window of each anchor, ranked, among rows of the anchor's
    label (same) or of the others.  `anchors` carries windows, a list of (id, low, high).

    Vectors meet only with vectors of their length.  A key's rows and anchors are dealt into
    blocks by hash; each pair of blocks is one task.
    """
    keys = ["dim", "key"]
    key = F.col("label") if same else F.lit(0).cast("long")
    placed = [side.withColumns({"dim": F.size("x"), "key": key}) for side in (rows, anchors)]
    sizes = [side.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
             for side, name in zip(placed, ("blocks", "shares"))]
    both = sizes[0].join(sizes[1], keys)
    # One row per label and dimension: joined as a table, whatever their number.
    right = placed[1].join(both, keys)
    left = placed[0].join(both, keys)
    block = lambda n: bucket_of(F.col("id"), 1 << 30) % F.col(n)
    left = left.withColumns({"block": block("blocks").cast("int"), "share": F.explode(F.sequence(F.lit(0), F.col("shares") - 1))})
    right = right.withColumns({"share": block("shares").cast("int"), "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))})
    at = [*keys, "block", "share"]
    # Both sides come from one table; new names keep them apart.
    right = right.select(*[F.col(c).alias(f"{c}_") for c in at], *[F.col(c).alias(f"a_{c}") for c in ("id", "label", "x", "windows")])
    found = (left.select(*at, "id", "label", "x").groupBy(*at)
             .cogroup(right.groupBy(*[f"{c}_" for c in at]))
             .applyInArrow(_search(k, same), FOUND))
    order = Window.partitionBy("anchor_id", "window_id").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component
    take no part; nor do rows with a component so large that a score could leave 64 bits.  Of
    several rows with one id that with the smallest (label, vector) counts.  Vectors of
    different lengths are never compared.  A positive whose window is empty gives no rows; a
    negative positive_score leaves none.  An empty table gives no rows.
    """
    rows = stored(whole_vectors(df, id_col, vector_col, label_col))
    anchors = rows.filter(F.col("id") % every == 0)
    whole = F.struct(F.lit(0).cast("long").alias("id"), F.lit(EVERYTHING[0]).alias("low"), F.lit(EVERYTHING[1]).alias("high"))
    near = stored(search(rows, anchors.withColumn("windows", F.array(whole)), positives, True)
                  .select("anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # LOW * p <= HALF * n <= HIGH * p, for whole n.
    p = F.col("positive_score")
    low = F.ceil(F.lit(LOW).cast("decimal(3,0)") * p / HALF).cast("long")
    high = F.floor(F.lit(HIGH).cast("decimal(3,0)") * p / HALF).cast("long")
    windows = (near.withColumns({"low": low, "high": high}).filter("low <= high").groupBy("anchor_id")
               .agg(F.sort_array(F.collect_list(F.struct(F.col("positive_id").alias("id"), "low", "high"))).alias("windows")))
    looking = anchors.join(windows, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    found = search(rows, looking, negatives, False)
    return (found.withColumnRenamed("window_id", "positive_id").join(near, ["anchor_id", "positive_id"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
