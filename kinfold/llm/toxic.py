"""Toxicity by maximum-scoring segments.

1. Per class, the labelled documents that hold a token are counted in BUCKETS hash buckets -
   a table of fixed size, whatever the vocabulary - and each bucket gets the log-odds of the
   classes under a Dirichlet prior proportional to the overall counts.  A token without
   significant log-odds of its own takes those of its first bytes (word forms of a stem),
   else nothing; every token also pays a small DRIFT, so that the score of clean text falls.
2. One linear scan per text finds all maximal-scoring segments (Ruzzo and Tompa, 1999).
3. Under the clean token distribution the best segment of n tokens follows an extreme-value
   law: P(S >= s) is about 1 - exp(-K n exp(-lambda s)).  lambda solves E[exp(lambda s)] = 1
   over the clean counts; K comes from the best segments of all clean labelled documents.
4. A document's evidence adds lambda s - log(K n) over its significant segments; the chance
   of label 1 given the evidence is a logistic curve, fitted to the evidence histogram of
   all labelled documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, split_group, stored
from .shingles import CACHED_WORDS

BUCKETS = 1 << 18
PRIOR = 0.1              # weight of the Dirichlet prior, as a share of all counts
SIGNIFICANT = 3.5        # z-value below which a log-odds counts as 0
STEMS = (5, 4)           # bytes of a word's beginning that stand in for it, in this order
DRIFT = 0.1
FLOOR = 3.0              # lambda * score of the weakest segment that is reported
LARGEST_E = 0.05         # expected chance segments below which one is significant
BIN, LOW, HIGH = 0.25, -20.0, 60.0
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1   # rows with crc32(id) mod FOLDS == HELD_OUT are never learnt from

_MARKS = bytes(32 if chr(b) in ".,;:!?\"'()[]{}<>|*_~`" else b for b in range(256))


class Places(dict):
    """word -> its buckets, packed: the word's, then one per stem; bounded like WordHashes."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word) % BUCKETS
        for k in STEMS:
            value = value * BUCKETS + xxhash.xxh3_64_intdigest(word[:k], k) % BUCKETS
        self[word] = value
        return value


def buckets(text: str | None, places: Places) -> np.ndarray:
    """(1 + stems, tokens): words without punctuation, A-Z lowered."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().translate(_MARKS).split()
    packed = np.fromiter(map(places.__getitem__, parts), np.int64, len(parts))
    bits = BUCKETS.bit_length() - 1
    return np.stack([(packed >> (bits * k)) & (BUCKETS - 1) for k in range(len(STEMS), -1, -1)])


def token_counts(labelled: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): documents per class that hold a token of the bucket, over all
    rows of (toxic, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places()
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[int(toxic > 0), np.unique(buckets(text, places))] += 1
        used = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(used), 50_000):
            k = used[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(counts[1, k]), pa.array(counts[0, k])],
                                             ["bucket", "toxic", "clean"])
    parts = labelled.select("toxic", "text").mapInArrow(run, "bucket int, toxic long, clean long")
    return parts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def token_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Log-odds per bucket, 0 where they are not significant."""
    prior = PRIOR * (toxic + clean) + 0.01
    a, b = toxic + prior, clean + prior
    odds = np.log(a) - np.log(a.sum() - a) - np.log(b) + np.log(b.sum() - b)
    z = odds / np.sqrt(1 / a + 1 / b)
    return np.where(np.abs(z) >= SIGNIFICANT, odds, 0.0)


def token_scores(odds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Score per token of `own` (see buckets): its word's odds, else its stems', minus DRIFT."""
    out = odds[own[0]]
    for stem in own[1:]:
        out = np.where(out == 0, odds[stem], out)
    return out - DRIFT


def decay(scores: np.ndarray, clean: np.ndarray) -> float:
    """lambda > 0 with E[exp(lambda * score)] = 1 over the clean tokens; 1 if there is none."""
    weight = clean / max(1.0, clean.sum())
    used = weight > 0
    weight, s = weight[used], scores[used]
    if not len(s) or s.max() <= 0 or (weight * s).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1e-6
    while (weight * np.exp(np.minimum(high * s, 700))).sum() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (weight * np.exp(np.minimum(mid * s, 700))).sum() < 1 else (low, mid)
    return max(low, 1e-3)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score), left to right, in linear time.

    Neighbours of one sign act as one item.  `links` holds for each kept segment the nearest
    earlier one that begins lower, so each is visited once per merge.
    """
    positive = scores > 0
    if not positive.any():
        return []
    edge = np.flatnonzero(positive[1:] != positive[:-1]) + 1
    begin = np.concatenate([[0], edge])
    end = np.append(edge, len(scores))
    total = np.concatenate([[0.0], np.cumsum(np.add.reduceat(scores, begin))])
    kept: list = []                      # (first, end, left sum, right sum, link)
    for k in np.flatnonzero(positive[begin]).tolist():
        first, stop, left, right = int(begin[k]), int(end[k]), float(total[k]), float(total[k + 1])
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append((first, stop, left, right, j))
                break
            first, left, link = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = link
    return [(f, e, r - l) for f, e, l, r, _ in kept]


SEGMENTS = "doc_id long, n_tokens long, best double, segments array<struct<first:int,end:int,score:double>>"


def scan(docs: DataFrame, odds: np.ndarray, rate: float) -> DataFrame:
    """Segments of every whole text of (doc_id, text)."""
    table = docs.sparkSession.sparkContext.broadcast(odds.astype(np.float32))  # BUCKETS values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, value = Places(), table.value.astype(np.float64)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            n, best, found = [], [], []
            for text in batch.column(1).to_pylist():
                s = token_scores(value, buckets(text, places))
                own = segments(s)
                n.append(len(s))
                best.append(max((x[2] for x in own), default=0.0))
                found.append([{"first": f, "end": e, "score": x} for f, e, x in own if rate * x >= FLOOR])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(found, kind)],
                ["doc_id", "n_tokens", "best", "segments"])
    return docs.mapInArrow(run, SEGMENTS)


def fit_logistic(x: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """(intercept, slope >= 0) of weighted points, by damped Newton steps with a small ridge."""
    a = b = 0.0
    if not len(x) or not ones.sum() or not zeros.sum():
        return -2.0, 1.0
    x, n = x.astype(float), (ones + zeros).astype(float)

    def loss(a, b):
        t = a + b * x
        return (n * np.logaddexp(0, t) - ones * t).sum() + 0.5 * 1e-3 * (a * a + b * b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -500, 500)))
        g = np.array([(n * p - ones).sum() + 1e-3 * a, ((n * p - ones) * x).sum() + 1e-3 * b])
        w = n * p * (1 - p)
        h = np.array([[w.sum(), (w * x).sum()], [(w * x).sum(), (w * x * x).sum()]]) + 1e-3 * np.eye(2)
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > loss(a, b):
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(size * step).max() < 1e-9:
            break
    return float(a), float(max(b, 1e-3))


def evidence(rate: float, log_k: float) -> Column:
    """Sum of lambda s - log(K n) over significant segments, or that of the best one."""
    base = F.lit(log_k) + F.log(F.greatest("n_tokens", F.lit(1)).cast("double"))
    strong = F.filter("segments", lambda s: F.lit(rate) * s["score"] - base > -math.log(LARGEST_E))
    summed = F.aggregate(strong, F.lit(0.0), lambda acc, s: acc + F.lit(rate) * s["score"] - base)
    return F.greatest(F.lit(LOW), F.least(F.lit(HIGH), F.when(F.size(strong) > 0, summed).otherwise(
        F.lit(rate) * F.col("best") - base)))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", label_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, segments, evidence, score, predicted.

    Learns from rows of `labels` outside the held-out fold; of several labels of an id the
    largest holds, null labels are none.  Null and empty texts have no tokens and get the
    score of no evidence.  A null id is not held out and has no label.  Without labels of
    both classes the curve is fixed.  An empty table gives no rows.
    """
    rows = documents(docs, id_col, text_col)
    known = (labels.filter(F.col(f"`{label_id}`").isNotNull() & F.col(f"`{label_col}`").isNotNull())
             .select(F.col(f"`{label_id}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")))
    known = known.filter(split_group(F.col("_id"), FOLDS) != HELD_OUT).groupBy("_id").agg(F.max("toxic").alias("toxic"))
    learnt = rows.filter(split_group(F.col("doc_id"), FOLDS) != HELD_OUT)
    # Labels grow with the texts, so both sides are dealt by id whatever their size.
    labelled = learnt.join(known.hint("merge"), F.col("doc_id") == F.col("_id"))
    counted = token_counts(labelled).toPandas()          # at most BUCKETS rows
    toxic, clean = np.zeros(BUCKETS), np.zeros(BUCKETS)
    toxic[counted["bucket"]], clean[counted["bucket"]] = counted["toxic"], counted["clean"]
    odds = token_odds(toxic, clean)
    rate = decay(odds - DRIFT, clean)

    found = stored(scan(rows, odds, rate))
    small = stored(found.join(known, F.col("doc_id") == F.col("_id"))
                   .select("n_tokens", "best", "segments", "toxic"))
    mean = (small.filter("toxic = 0 and n_tokens > 0 and best > 0")
            .agg(F.avg(F.lit(rate) * F.col("best") - F.log(F.col("n_tokens").cast("double")))).first()[0])
    log_k = (mean if mean is not None else 0.0) - 0.5772156649015329     # mean of a Gumbel law
    x = evidence(rate, log_k)
    bins = (small.groupBy(F.floor(x / BIN).alias("bin")).agg(
        F.sum("toxic").alias("ones"), F.sum(1 - F.col("toxic")).alias("zeros")).toPandas())  # (HIGH - LOW) / BIN rows
    a, b = fit_logistic((bins["bin"].to_numpy() + 0.5) * BIN, bins["ones"].to_numpy(), bins["zeros"].to_numpy())
    out = found.withColumn("evidence", x)
    out = out.withColumn("score", 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("evidence")))))
    held = F.coalesce(split_group(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "segments", "evidence", "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
