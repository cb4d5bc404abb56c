"""Quality by regularised quadratic discriminant analysis of document statistics.

1. Every whole text becomes one vector of statistics: lengths on a log scale, shares (of
   capitals, signs, repeated words and lines, ...) by the arcsine of their root, which
   evens out their variance.
2. Count, sums and products of the vectors are added up per class over all labelled
   training documents.  Each class covariance is shrunk towards the pooled one and both
   towards a sphere, so that no direction without spread in the sample decides alone.
3. A vector's score is the difference of the two Gaussian log densities.  Each covariance
   is factored once (Cholesky); a Mahalanobis distance is then one triangular product.
4. Gaussian differences are overconfident: a logistic curve, fitted to the histogram of
   differences over the labelled training documents, turns them into chances.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, split_group, stored
from .toxic import fit_logistic

NAMES = ["bytes", "words", "upper", "digit", "high", "bang", "bar", "sign", "stop", "space", "run",
         "distinct", "top", "length", "spread", "entropy", "line_copies", "line_words"]
POOLED = 0.10            # share of the pooled covariance in that of a class
SPHERE = 0.002           # share of the sphere of equal trace in that
BIN, LIMIT = 0.5, 200.0  # histogram of log density differences
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0   # rows with crc32(id) mod FOLDS == HELD_OUT are never learnt from

_STOPS = list(b".,;:?'\"-()")
_SIGNS = list(b"#$%&*+/<=>@[\\]^_`{}~")


def _shares(counts: list[float], totals: list[float]) -> np.ndarray:
    part, whole = np.array(counts, float), np.maximum(np.array(totals, float), 1)
    return np.arcsin(np.sqrt(np.clip(part / whole, 0, 1)))


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of a text, in the order of NAMES; all 0 without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return np.zeros(len(NAMES))
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    high = int(kinds[128:].sum())
    size = len(raw)
    bar, bang = int(kinds[124]), int(kinds[33])
    known = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    p = kinds[kinds > 0] / size
    shares = _shares(
        [upper, kinds[48:58].sum(), high, bang, bar, kinds[_SIGNS].sum(), kinds[_STOPS].sum(), kinds[9:14].sum() + kinds[32],
         sum(map(eq, words, words[1:])), len(known), max(known.values()), len(lines) - len(set(lines))],
        [upper + lower, size, size, n, n, size, size, size, n, n, n, len(lines)])
    return np.concatenate([
        [np.log1p(size), np.log1p(n)], shares[:11],
        [np.log(lengths.mean()), np.log1p(lengths.std()), -(p * np.log2(p)).sum()],
        shares[11:], [np.log1p(n / len(lines))]])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of (doc_id, text), a batch of texts at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                texts = batch.column(1).slice(at, 1000)
                stats = np.stack([statistics(t.as_py()) for t in texts])
                flat = pa.array(stats.ravel(), pa.float64())
                ends = pa.array(np.arange(0, stats.size + 1, len(NAMES)), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1000), pa.ListArray.from_arrays(ends, flat)],
                                                 ["doc_id", "stats"])
    return docs.mapInArrow(run, "doc_id long, stats array<double>")


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def class_moments(labelled: DataFrame) -> DataFrame:
    """(label, place, total): per class the flattened [count, sums, products] over (label, stats)."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label, x = batch.column(0).to_numpy(zero_copy_only=False) > 0, matrix(batch.column(1))
            for k in (0, 1):
                own = x[label == k]
                sums[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        place = np.arange(sums.shape[1])
        for k in (0, 1):
            if sums[k, 0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), k), pa.int32()), pa.array(place, pa.int32()),
                                                  pa.array(sums[k])], ["label", "place", "total"])
    parts = labelled.select("label", "stats").mapInArrow(run, "label int, place int, total double")
    return parts.groupBy("label", "place").agg(F.sum("total").alias("total"))


@dataclass(frozen=True)
class Gaussian:
    """One class: prior, mean, and the inverse of its covariance's Cholesky factor."""

    prior: float
    mean: np.ndarray
    whiten: np.ndarray
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return np.log(self.prior) - 0.5 * (self.log_det + (z * z).sum(axis=1))


def discriminant(sums: np.ndarray, pooled: float = POOLED, sphere: float = SPHERE) -> list[Gaussian] | None:
    """Both classes from their (2, 1 + d + d * d) moments; None if one has under two rows."""
    d = len(NAMES)
    n = sums[:, 0]
    if n.min() < 2:
        return None
    mean = sums[:, 1:1 + d] / n[:, None]
    own = sums[:, 1 + d:].reshape(2, d, d) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    joint = (own * n[:, None, None]).sum(axis=0) / n.sum()
    # Shares and logarithms differ in scale: the sphere is one in units of the overall spread.
    between = mean[1] - mean[0]
    scale = np.sqrt(np.diag(joint) + between**2 * n[0] * n[1] / n.sum()**2) + 1e-6
    unit = np.outer(scale, scale)
    out = []
    for k in (0, 1):
        cov = ((1 - pooled) * own[k] + pooled * joint) / unit
        cov = (1 - sphere) * cov + sphere * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten = np.linalg.inv(factor) / scale[None, :]
        log_det = 2 * (np.log(np.diag(factor)).sum() + np.log(scale).sum())
        out.append(Gaussian(n[k] / n.sum(), mean[k], whiten, float(log_det)))
    return out


def differences(model: list[Gaussian] | None, x: np.ndarray) -> np.ndarray:
    """Log density of class 1 minus that of class 0, within LIMIT; 0 without a model."""
    if model is None:
        return np.zeros(len(x))
    return np.clip(model[1].log_density(x) - model[0].log_density(x), -LIMIT, LIMIT)


def _compared(frame: DataFrame, keep: str, model: list[Gaussian] | None) -> DataFrame:
    """(keep, diff) of (keep, stats)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(differences(model, matrix(batch.column(1))))],
                                             [keep, "diff"])
    return frame.select(keep, "stats").mapInArrow(run, f"{keep} {frame.schema[keep].dataType.simpleString()}, diff double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, stats, difference, score, predicted.

    Learns from rows of `labels` outside the held-out fold; of several labels of an id the
    smallest holds, null labels are none.  Null, empty and white-space texts have zeros for
    statistics and are scored like any other vector.  A null id is not held out and has no
    label.  Repeated rows are scored each.  Without two labelled documents of either class
    all differences are 0 and the curve is fixed.  An empty table gives no rows.
    """
    rows = documents(docs, id_col, text_col)
    known = (labels.filter(F.col(f"`{label_id}`").isNotNull() & F.col(f"`{label_col}`").isNotNull())
             .select(F.col(f"`{label_id}`").cast("long").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("label")))
    known = known.filter(split_group(F.col("_id"), FOLDS) != HELD_OUT).groupBy("_id").agg(F.min("label").alias("label"))
    found = stored(document_statistics(rows))
    # Labels grow with the texts, so both sides are dealt by id whatever their size.
    labelled = stored(found.join(known.hint("merge"), F.col("doc_id") == F.col("_id")).select("label", "stats"))
    sums = np.zeros((2, 1 + len(NAMES) + len(NAMES)**2))
    for r in class_moments(labelled).collect():              # 2 * (1 + d + d * d) rows
        sums[r.label, r.place] = r.total
    model = discriminant(sums)
    bins = (_compared(labelled, "label", model).groupBy(F.floor(F.col("diff") / BIN).alias("bin"))
            .agg(F.sum(F.when(F.col("label") > 0, 1).otherwise(0)).alias("ones"), F.count("*").alias("n"))
            .toPandas())                                     # 2 * LIMIT / BIN + 1 rows
    a, b = fit_logistic((bins["bin"].to_numpy(float) + 0.5) * BIN, bins["ones"].to_numpy(float),
                        (bins["n"] - bins["ones"]).to_numpy(float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            diff = differences(model, matrix(batch.column(1)))
            score = 1 / (1 + np.exp(-np.clip(a + b * diff, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(diff), pa.array(score)],
                                             ["doc_id", "stats", "difference", "score"])
    out = found.mapInArrow(run, "doc_id long, stats array<double>, difference double, score double")
    held = F.coalesce(split_group(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "stats", "difference", "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
