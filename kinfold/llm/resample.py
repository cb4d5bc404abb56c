"""Importance resampling towards a target distribution.

1. Words and word pairs of all texts fall into BUCKETS buckets.  Each task adds its texts up
   in one array; so do the target's texts.  The gain of a bucket is the logarithm of its
   share among the target's features over its share among the corpus's.
2. The gains are one array of BUCKETS integers: a text's weight is the mean of the entries
   its features point at.  Noise of a Gumbel law, drawn from the row key, turns the highest
   scores into a sample without replacement in proportion to exp(weight).
3. The cutoff: a quantile sketch of the scores gives a bracket around the wanted rank.  Exact
   counts above and inside it validate the bracket, or widen it until it holds the rank.
   Only the rows in the bracket are sorted to find the row at the cutoff.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, stored

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
SCALE = 1000             # gains and noise count in thousandths
SKETCH = 1000            # the sketch errs by at most one part in SKETCH of the ranks
CACHED_WORDS = 500_000   # distinct words remembered per worker

# A-Z lowered; every byte outside 0-9, a-z and the letters beyond ASCII separates words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class WordSums(dict):
    """word -> its crc32; forgets everything once it holds CACHED_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = crc32(word)
        return value


def features(text: str | None, sums: WordSums) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every word and pair of neighbours.  The checksum of
    a pair goes on from that of its first word."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    n = len(words)
    if not n:
        return 0, np.empty(0, np.int64)
    own = [sums[w] for w in words]
    pairs = [crc32(b" " + w, before) for w, before in zip(words[1:], own)]
    out = np.fromiter(own, np.int64, n), np.fromiter(pairs, np.int64, n - 1)
    return n, np.concatenate(out) % BUCKETS


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): features per bucket over all rows of (text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = WordSums(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += np.bincount(features(text.as_py(), sums)[1], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["bucket", "n"])
    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """floor(SCALE * ln((t + 1)(S + B) / ((s + 1)(T + B)))) per bucket, in doubles."""
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for counts, frame in ((s, corpus), (t, target)):
        for r in frame.collect():                            # at most BUCKETS rows
            counts[r.bucket] = r.n
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of (doc_id, text): the floored mean gain."""
    table = gain.copy()                                      # BUCKETS integers in the closure

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = WordSums()
        for batch in batches:
            words, count, weight = [], [], []
            for text in batch.column(1):
                n, own = features(text.as_py(), sums)
                words.append(n)
                count.append(len(own))
                weight.append(int(table[own].sum()) // len(own) if n else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, count, weight))],
                ["doc_id", "n_words", "n_features", "weight"])
    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """A Gumbel value in thousandths, fixed by the row key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


ORDER = [F.desc, F.asc_nulls_last, F.asc, F.asc]             # of score, doc_id and what tells repeated ids apart
KEYS = ["score", "doc_id", "n_features", "weight"]


def _order() -> list[Column]:
    return [by(k) for by, k in zip(ORDER, KEYS)]


def _reaches(row) -> Column:
    """Rows that do not come after `row`."""
    score, doc_id, n, weight = (F.col(k) for k in KEYS)
    later = [(n < row.n_features) | ((n == row.n_features) & (weight <= row.weight))]
    same = doc_id.eqNullSafe(F.lit(row.doc_id).cast("long"))
    before = doc_id.isNotNull() if row.doc_id is None else F.coalesce(doc_id < row.doc_id, F.lit(False))
    return (score > row.score) | ((score == row.score) & (before | (same & later[0])))


def bracket(rows: DataFrame, k: int, total: int, sketch: int = SKETCH) -> tuple[int, int, int, list]:
    """(low, high, above, tried): scores low..high hold the k-th highest of `total` rows, and
    `above` rows score more than high.  `tried` lists every bracket with its exact counts."""
    slack, tried = 2.0 / sketch, []
    want = 1 - (k - 0.5) / total
    while True:
        ends = [max(0.0, want - slack), min(1.0, want + slack)]
        low, high = rows.agg(F.percentile_approx("score", F.array(*map(F.lit, ends)), F.lit(sketch))).first()[0]
        if ends == [0.0, 1.0]:                               # the sketch keeps both ends, but need not be believed
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        above, inside = rows.agg(F.count_if(F.col("score") > high),
                                 F.count_if(F.col("score").between(low, high))).first()
        tried.append((low, high, above, inside))
        if above < k <= above + inside:
            return low, high, above, tried
        slack *= 4


def cutoff(rows: DataFrame, k: int, total: int, sketch: int = SKETCH):
    """The k-th row of `rows` by KEYS.  The sorted bracket stays spread over range partitions;
    their counts tell in which one the row lies."""
    low, high, above, _ = bracket(rows, k, total, sketch)
    inside = rows.filter(F.col("score").between(low, high)).select(*KEYS)
    ordered = stored(inside.repartitionByRange(*_order()).sortWithinPartitions(*_order())
                     .withColumn("part", F.spark_partition_id()))
    left = k - above
    for part, n in sorted(tuple(r) for r in ordered.groupBy("part").count().collect()):   # one row a task
        if left <= n:
            break
        left -= n
    own = Window.partitionBy("part").orderBy(*_order())
    return ordered.filter(F.col("part") == part).withColumn("at", F.row_number().over(own)).filter(F.col("at") == left).first()


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, sketch: int = SKETCH) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    Of the N documents with at least `least_words` words the floor(percent * N / 100) highest
    scores are drawn and ranked from 1, ties to smaller ids (null last); the rest have a null
    rank.  Null and empty texts have no features, weight 0, and are never drawn.  Repeated
    rows count each; rows of one id share their noise.  An empty target makes all gains those
    of zero counts; an empty table gives no rows.
    """
    rows = documents(docs, id_col, text_col)
    table = gains(bucket_counts(rows), bucket_counts(target.select(F.col(f"`{target_col}`").alias("text"))))
    scored = stored(weigh(rows, table).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    eligible = scored.filter(F.col("n_words") >= least_words)
    total = eligible.count()
    k = percent * total // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    last = cutoff(eligible, k, total, sketch)
    is_drawn = (F.col("n_words") >= least_words) & _reaches(last)
    drawn = scored.filter(is_drawn).select(*columns)
    # Noise spreads even equal texts over some thousand scores: a rank is the count of better
    # scores plus the place within one score.
    counts = drawn.groupBy("score").agg(F.count("*").alias("n"))
    better = counts.select(F.col("score").alias("_score"), (F.sum("n").over(
        Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))).alias("_better"))
    place = F.row_number().over(Window.partitionBy("score").orderBy(*_order()[1:]))
    ranked = (drawn.withColumn("_place", place).join(better, F.col("score") == F.col("_score"))
              .select(*columns, (F.coalesce("_better", F.lit(0)) + F.col("_place")).cast("long").alias("rank")))
    rest = scored.filter(~is_drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)
