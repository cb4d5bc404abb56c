"""Hard negatives, quality and resampling: brute force, held-out accuracy, edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import negatives, quality, resample

SF = "/root/testdata/sf0.01"
CLASHES = ["n", "id", "x", "key", "share", "block", "rank", "score", "stats", "_id", "label_", "weight", "windows"]


def clashing(df):
    for name in CLASHES:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(name))
    return df


# --- hard negatives -------------------------------------------------------------------

def negatives_brute(rows):
    """rows: {id: (label, integer vector)}"""
    out = []
    for a, (la, xa) in rows.items():
        if a % 50:
            continue
        scored = sorted((-sum(p * q for p, q in zip(xa, x)), i) for i, (_, x) in rows.items() if i != a and len(x) == len(xa))
        same = [(i, -s) for s, i in scored if rows[i][0] == la][:5]
        for p, ps in same:
            fit = [(i, -s) for s, i in scored if rows[i][0] != la and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a, p, k + 1, i, ps, s) for k, (i, s) in enumerate(fit)]
    return sorted(out)


def quantised(i, label, vector):
    return ((label + 1) % 10 if i % 7 == 0 else label), [math.floor(256 * c) for c in vector]


@pytest.mark.parametrize("block", [4096, 37])
def test_negatives_match_brute_force(spark, monkeypatch, block):
    """Clustered vectors on a coarse grid: many ties; small blocks meet again in Spark."""
    monkeypatch.setattr(negatives, "BLOCK", block)
    rng = random.Random(4)
    centres = [[rng.randrange(-6, 7) / 8 for _ in range(6)] for _ in range(12)]
    rows = [(i, [c + rng.choice([0, 0, 0.125, -0.125]) for c in rng.choice(centres)], rng.choice([0, 0, 0, 1, 2])) for i in range(400)]
    rows += [(i, [1.0, 0.5], 1 + i % 3) for i in range(1000, 1060)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = sorted(tuple(r) for r in negatives.hard_negatives(df).collect())
    want = negatives_brute({i: quantised(i, lab, v) for i, v, lab in rows})
    assert want and got == want


def test_reading_stops_at_the_threshold():
    """On skewed lists few rows are scored; a tie with the threshold reads on."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.pareto(1.5, (5000, 4)) * 20).astype(np.int64)
    lists = negatives.Lists(np.arange(5000), x)
    anchor = np.array([3, 1, 2, 5])
    every = np.array([negatives.EVERYTHING[0]]), np.array([negatives.EVERYTHING[1]])
    (found,), scored = lists.best(anchor, np.ones(5000, bool), *every, 5)
    scores = x @ anchor
    assert found.tolist() == sorted(range(5000), key=lambda i: (-scores[i], i))[:5] and scored < 1500
    flat = negatives.Lists(np.arange(3000)[::-1], np.ones((3000, 2), np.int64))
    (found,), scored = flat.best(np.array([1, 1]), np.ones(3000, bool), *every, 3)
    assert flat.ids[found].tolist() == [0, 1, 2] and scored == 3000
    # A window whose lower end the threshold has passed is done, full or not.
    (found,), scored = lists.best(anchor, np.ones(5000, bool), np.array([scores.max() + 1]), np.array([scores.max() + 9]), 3)
    assert not len(found) and scored < 500
    (found,), _ = lists.best(np.zeros(4, np.int64), np.ones(5000, bool), np.array([0]), np.array([0]), 2)
    assert lists.ids[found].tolist() == [0, 1]


def test_negatives_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.25], 1), (2, [0.75, 0.1], 2), (3, None, 1), (4, [], 1), (5, [nan, 1.0], 1),
            (6, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 1.0], None), (None, [0.8, 0.0], 3),
            (2, [0.75, 0.1], 2), (50, [0.0, 0.0], 5), (51, [0.0, 0.0], 5), (11, [3e38, 0.0], 2), (-50, [-1.0, 0.0], 2)]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = sorted(tuple(r) for r in negatives.hard_negatives(df).collect())
    usable = {i: quantised(i, lab, v) for i, v, lab in rows
              if i is not None and lab is not None and v and i not in (5, 6, 8, 11)}
    assert got == negatives_brute(usable)
    assert (50, 51, 1, -50, 0, 0) in got                     # a zero score has a window of zero
    assert negatives.hard_negatives(df.limit(0)).collect() == []
    assert negatives.hard_negatives(df.filter("vec_id = 1")).collect() == []
    doubles = df.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted(tuple(r) for r in negatives.hard_negatives(doubles).collect()) == got


# --- quality --------------------------------------------------------------------------

def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    held = [(out[r.doc_id], r.quality) for r in labels.collect() if out[r.doc_id].held_out]
    right = sum(o.predicted == q for o, q in held) / len(held)
    junk = [o.predicted for o, q in held if q == 0]
    assert len(held) > 50 and right >= 0.97 and sum(junk) <= 0.1 * len(junk)


def test_quality_ignores_held_out_labels_and_other_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.quality(other, turned).collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_discriminant_is_the_density_difference():
    """The factored form against densities written out with inverse and determinant."""
    rng = np.random.default_rng(2)
    d = len(quality.NAMES)
    sums, points = np.zeros((2, 1 + d + d * d)), rng.normal(size=(20, d))
    for k in (0, 1):
        x = rng.normal(size=(300, d)) @ rng.normal(size=(d, d)) * 0.3 + k
        sums[k] = np.concatenate([[300], x.sum(0), (x.T @ x).ravel()])
    model = quality.discriminant(sums, pooled=0.2, sphere=0.05)
    plain = np.zeros((2, 20))
    mean = sums[:, 1:1 + d] / 300
    own = [sums[k, 1 + d:].reshape(d, d) / 300 - np.outer(mean[k], mean[k]) for k in (0, 1)]
    joint = (own[0] + own[1]) / 2
    scale = np.sqrt(np.diag(joint) + (mean[1] - mean[0])**2 / 4) + 1e-6
    for k in (0, 1):
        cov = (0.8 * own[k] + 0.2 * joint) / np.outer(scale, scale)
        cov = (0.95 * cov + 0.05 * np.trace(cov) / d * np.eye(d)) * np.outer(scale, scale)
        z = points - mean[k]
        plain[k] = -0.5 * (np.linalg.slogdet(cov)[1] + np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z))
    want = np.clip(plain[1] - plain[0], -quality.LIMIT, quality.LIMIT)
    assert np.allclose(quality.differences(model, points), want, atol=1e-6)


LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
TEXTS = [(1, "One two three. Four five"), (2, None), (3, ""), (4, " \n\t "), (None, "no id here"), (5, LONG), (6, "a"),
         (6, "a"), (7, "ﬁ ▁ \U0001f600 é\u0000 z"), (None, None), (8, " ".join(["word"] * 25)), (9, " ".join(["word"] * 25)),
         (9, "B " * 30)]


@pytest.fixture(scope="module")
def texts(spark):
    return clashing(spark.createDataFrame(TEXTS, "doc_id long, text string")).withColumn("label", F.lit("label"))


def test_quality_edges(spark, texts):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (6, 1, 1), (None, 1, 0), (5, None, 0), (7, 0, 0), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        rows = quality.quality(texts, known).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        assert all(len(r.stats) == len(quality.NAMES) and np.isfinite(r.stats).all() for r in rows)
    assert not any(r.held_out for r in rows if r.doc_id is None)
    assert quality.quality(texts.limit(0), labels).collect() == []


# --- resampling -----------------------------------------------------------------------

def resample_brute(texts, target, percent=25, least=20):
    def features(t):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())
        words, word = [], b""
        for b in low + b" ":
            if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
                word += bytes([b])
            elif word:
                words.append(word)
                word = b""
        grams = words + [a + b" " + b for a, b in zip(words, words[1:])]
        return len(words), [zlib.crc32(g) % 10_000 for g in grams]
    own = [features(t) for _, t in texts]
    s, t = [0] * 10_000, [0] * 10_000
    for _, f in own:
        for k in f:
            s[k] += 1
    for x in target:
        for k in features(x)[1]:
            t[k] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for (i, _), (n, f) in zip(texts, own):
        w = sum(gain[k] for k in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("sketch", [1000, 2, 7])
def test_resample_matches_brute_force(spark, sketch):
    """Rough sketches widen their brackets; the sample stays the same."""
    rng = random.Random(8)
    texts = [(i if i % 11 else i // 2, " ".join(rng.choice(["Alpha", "beta-x", "γ", "d9", "e", "f!"]) for _ in range(rng.randrange(0, 60))))
             for i in range(500)] + TEXTS
    target = ["alpha beta γ", None, "d9 d9 alpha"]
    docs = clashing(spark.createDataFrame(texts, "doc_id long, text string"))
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = sorted((tuple(r) for r in resample.resample(docs, goal, sketch=sketch).collect()), key=str)
    assert got == resample_brute(texts, target)


def test_bracket_is_validated_and_widened(spark):
    """A hot score and a false sketch: exact counts decide."""
    scores = [5] * 4000 + list(range(6, 1006)) + list(range(-995, 5))
    rows = spark.createDataFrame([(s, i, 1, 0) for i, s in enumerate(scores)], "score long, doc_id long, n_features long, weight long")
    ranked = sorted(((s, i) for i, s in enumerate(scores)), key=lambda r: (-r[0], r[1]))
    for k in (1, 17, 1000, 1001, 3500, 5000, 5001, 5999, 6000):
        low, high, above, tried = resample.bracket(rows, k, len(scores), 10)
        assert above == sum(s > high for s in scores) < k <= above + sum(low <= s <= high for s in scores)
        assert all(not (a < k <= a + n) for _, _, a, n in tried[:-1])
        row = resample.cutoff(rows, k, len(scores), 10)
        assert (row.score, row.doc_id) == ranked[k - 1]


def test_resample_edges(spark, texts):
    goal = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert resample.resample(texts.limit(0), goal).collect() == []
    rows = resample.resample(texts, goal.limit(0)).collect()
    assert len(rows) == len(TEXTS)
    assert sorted((tuple(r) for r in rows), key=str) == resample_brute(TEXTS, [])
    few = resample.resample(texts.filter("doc_id = 6"), goal).collect()
    assert [r["rank"] for r in few] == [None, None]
