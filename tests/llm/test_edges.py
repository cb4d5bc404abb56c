"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from kinfold.llm import cover, exact, lines, lm, minhash, mixing, pieces, suffix, toxic, warc

CLASHES = ["n", "id", "share", "start", "digest", "_id", "component", "words", "held", "size", "block", "rank"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "a b c d e f g", "en", "s1", 13), (2, "a b c d e f g", "en", None, 13), (3, None, None, "s1", None),
    (4, "", "de", "s2", 0), (5, " \n\t ", None, None, 4), (6, "x", "en", "s2", 1), (7, LONG, "en", "s1", len(LONG)),
    (8, LONG, "en", "s3", len(LONG)), (None, "a b c d e f g", None, None, None), (None, None, None, None, None),
    (9, "repeated row text", "en", "s1", 17), (9, "repeated row text", "en", "s1", 17),
    (10, "ﬁ ▁ \U0001f600 é\u0000 z", "xx", "s2", 9), (-5, "l1\nl2\nl3\nl4\nl1\nl2\nl3", "en", "s1", 20),
    (11, "l2\nl3\nl4\nother", "en", "s1", 14)]
LABELS = [(1, 1, 0), (4, 0, 1), (6, None, 1), (None, 1, 1), (7, 1, None), (1, 0, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name in CLASHES:
        docs = docs.withColumn(name, F.lit(name))
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    return docs, labels


def run_all(docs, labels):
    return {
        "toxic": toxic.toxicity(docs, labels).collect(),
        "lines": lines.line_dedup(docs).collect(),
        "near": minhash.near_dedup(docs).collect(),
        "exact": exact.exact_dedup(docs).collect(),
        "lm": lm.log_likelihood(docs).collect(),
        "suffix": suffix.remove_repeats(docs).collect(),
        "mix": mixing.mixed_sizes(docs).collect(),
        "mixed": mixing.mixed_documents(docs).collect(),
        "pieces": pieces.encode(docs).collect(),
    }


def test_every_operator_takes_edge_cases(tables):
    docs, labels = tables
    out = run_all(docs, labels)
    n = len(ROWS)
    for name in ("toxic", "lines", "near", "exact", "lm", "suffix", "mix"):
        assert len(out[name]) == n, name
    near = {r.doc_id: r for r in out["near"] if r.doc_id is not None}
    assert near[2].component_id == 1 and not near[2].kept and near[8].component_id == 7
    assert near[3].n_shingles == near[4].n_shingles == near[5].n_shingles == 0 and near[5].kept
    assert near[6].n_shingles == 1 and near[7].n_shingles == 29_996
    same = {r.doc_id: r for r in out["exact"]}
    assert (same[1].keep_id, same[1].group_size, same[1].kept) == (2, 3, False)
    assert same[3].text_sha256 == same[4].text_sha256 == hashlib.sha256(b"").hexdigest()
    assert same[3].keep_id == 4 and not same[None].kept
    assert [r.kept for r in out["exact"] if r.doc_id == 9] == [True, True]
    cut = {r.doc_id: r for r in out["suffix"]}
    assert cut[8].n_removed == cut[8].n_bytes == len(LONG) and cut[8].n_spans == 1 and cut[7].n_removed == 0
    assert cut[3].n_bytes == 0 and cut[9].n_removed == 0
    line = {r.doc_id: r for r in out["lines"]}
    assert (line[-5].n_lines, line[-5].n_removed, line[-5].n_spans) == (7, 3, 1) and line[-5].text == "l1\nl2\nl3\nl4"
    assert line[11].n_removed == 3 and line[11].text == "other"
    assert line[3].n_lines == 1 and line[9].n_removed == 0
    assert all(r.exact for r in out["pieces"])
    assert {r.n_pieces for r in out["pieces"] if r.doc_id in (3, 4)} == {0}
    scored = {r.doc_id: r for r in out["lm"]}
    assert sorted(r.n_tokens for r in out["lm"] if r.doc_id is None) == [1, 8]
    twice = [r for r in out["lm"] if r.doc_id == 9]
    assert [r.n_tokens for r in twice] == [4, 4] and twice[0].base_score == pytest.approx(twice[1].base_score)
    assert scored[3].n_tokens == scored[4].n_tokens == 1 and scored[1].n_tokens == 8
    assert all((zlib.crc32(str(d).encode()) % 10 == 0) == r.held_out for d, r in scored.items() if d is not None)
    assert all(0 <= r.score <= 1 for r in out["toxic"])
    for r in out["mix"]:
        assert 0 <= r.taken <= 3 * r.size
    assert sum(r.taken for r in out["mix"]) == sum(len(r.text.split()) for r in out["mixed"])


def test_empty_tables(tables):
    docs, labels = tables
    out = run_all(docs.limit(0), labels.limit(0))
    assert all(rows == [] for rows in out.values())
    index, _ = warc.archive(docs.limit(0).select(F.col("doc_id").alias("page_id"), "lang", "text"),
                            url_col="lang", payload_col="text")
    assert index.count() == 0


def test_no_labels(tables):
    docs, labels = tables
    rows = toxic.toxicity(docs, labels.limit(0)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 0), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0),
            (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (None, [1.0, 0.0], 0), (10, [0.0, -1.0], 0),
            (11, [1.0, 0.0], None), (12, [1.0, 0.3], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit("x"))
    out = {r.vec_id: r for r in cover.near_vectors(df).collect()}
    assert len(out) == len(rows)
    assert out[1].n_links == 4 and out[12].component_id == 1 and not out[12].kept
    for k in (4, 5, 6, 7, 8, 9, 10):
        assert (out[k].n_links, out[k].component_id, out[k].kept) == (0, k, True)
    assert cover.near_vectors(df.limit(0)).count() == 0 and cover.near_vectors(df.filter("vec_id = 4")).count() == 1


def test_very_small_and_large_components(spark):
    rows = [(1, [1e-200, 0.0]), (2, [2e-200, 0.0]), (3, [1e200, 0.0]), (4, [1.0, 0.0]), (5, [5e-324, 0.0]),
            (6, [1.7e308, 1.7e308]), (7, [1e-300, 1e-300]), (8, [1e-200, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r.vec_id: (r.n_links, r.component_id) for r in cover.near_vectors(df).collect()}
    assert out == {k: (4, 1) for k in range(1, 6)} | {6: (1, 6), 7: (1, 6), 8: (0, 8)}


def test_payloads_with_equal_digests_but_different_bytes(spark, monkeypatch):
    """Payloads whose SHA-1 collides stay apart."""
    monkeypatch.setattr(warc.F, "sha1", lambda c: F.lit("0" * 40))
    df = spark.createDataFrame([(1, "u", "a" * 1500), (2, "u", "b" * 1500), (3, "u", "a" * 1500)],
                               "page_id long, url string, html string")
    assert {r.page_id: r.refers_to for r in warc.plan_records(df).collect()} == {1: 3, 2: None, 3: None}


def test_pages(spark):
    big = "p" * 1500
    rows = [(1, "u\r\n1", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "é", ""),
            (None, "n", big), (7, "u", "q" * 700_000), (2, None, big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    out = warc.archived_pages(df).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.record_type == "revisit") == (r.refers_to is not None)
    by = {r.page_id: r for r in out}
    assert by[1].refers_to == 2 and by[None].refers_to == 2 and by[2].record_type == "response"
    assert by[1].payload_bytes == 1500 and by[1].payload_digest == hashlib.sha1(big.encode()).hexdigest()
    assert by[5].payload_digest == hashlib.sha1(b"").hexdigest() and by[7].payload_bytes == 700_000
