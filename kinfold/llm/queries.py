"""The operators as queries over the test tables, with check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from kinfold.examples.tables import table

from . import cover, exact, lines, lm, minhash, mixing, negatives, pieces, quality, resample, suffix, toxic, warc


def op1_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, t, strlen(t) AS n, max(page_id) OVER (PARTITION BY t) AS head,
             count(*) OVER (PARTITION BY t) AS copies FROM p)
SELECT page_id, n AS payload_bytes, sha1(t) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> head THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> head THEN head END AS refers_to
FROM h
"""


def op2_cover_tree(spark, sf_dir):
    return cover.near_vectors(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r(vec_id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS root FROM r GROUP BY vec_id)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.root AS component_id, e.vec_id = c.root AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n ON n.a = e.vec_id
"""


def op3_toxicity(spark, sf_dir):
    out = toxic.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op4_pieces(spark, sf_dir):
    return pieces.summary(pieces.encode(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark, sf_dir):
    out = lines.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_spans",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
s AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d WHERE len(l) >= 3),
w AS (SELECT doc_id, i, l[i] || chr(10) || l[i + 1] || chr(10) || l[i + 2] AS t FROM s),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS n FROM w),
c AS (SELECT doc_id, list_sort(list_distinct(flatten(list([i, i + 1, i + 2])))) AS c
      FROM r WHERE n > 1 GROUP BY doc_id),
m AS (SELECT d.doc_id, l, coalesce(c, []::BIGINT[]) AS c FROM d LEFT JOIN c USING (doc_id))
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(c) AS BIGINT) AS n_removed,
       CAST(len(list_filter(c, lambda x: NOT list_contains(c, x - 1))) AS BIGINT) AS n_spans,
       sha256(array_to_string(list_transform(list_filter(range(1, len(l) + 1),
              lambda i: NOT list_contains(c, i)), lambda i: l[i]), chr(10))) AS kept_sha256
FROM m
"""


def op6_minhash(spark, sf_dir):
    return minhash.near_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(
        CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents
                    UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""


def op7_exact_dedup(spark, sf_dir):
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


def op8_language_model(spark, sf_dir):
    return lm.log_likelihood(table(spark, sf_dir, "documents"))


def op9_suffix_array(spark, sf_dir):
    out = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_mixing(spark, sf_dir):
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op11_threshold_negatives(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(CAST(embedding AS DOUBLE[]), lambda c: CAST(floor(256 * c) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
s AS (SELECT a.id AS a, b.id AS b, a.label = b.label AS same,
             CAST(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS BIGINT) AS s
      FROM v a JOIN v b ON a.id % 50 = 0 AND a.id <> b.id AND len(a.x) = len(b.x)),
p AS (SELECT a, b AS p, s AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p ORDER BY s DESC, b) AS INTEGER) AS rank, b AS negative_id,
       ps AS positive_score, s AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT same AND 50 * ps <= 100 * s AND 100 * s <= 95 * ps
QUALIFY row_number() OVER (PARTITION BY p.a, p ORDER BY s DESC, b) <= 3
"""


def op12_discriminant(spark, sf_dir):
    out = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op13_resample(spark, sf_dir):
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op13_features(name, key):
    words = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return (f"SELECT {key} AS id, len(w) AS n_words, list_concat(w, list_transform(range(1, len(w)), "
            f"lambda i: w[i] || ' ' || w[i + 1])) AS f FROM (SELECT {key}, {words} AS w FROM {name})")


# The checksum's table and its steps, byte by byte, are those of the public definition.
OP13_SQL = f"""
WITH d AS MATERIALIZED ({_op13_features("documents", "doc_id")}),
b AS MATERIALIZED ({_op13_features("benchmark", "item_id")}),
df AS MATERIALIZED (SELECT id, unnest(f) AS f FROM d), bf AS MATERIALIZED (SELECT unnest(f) AS f FROM b),
t AS MATERIALIZED (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
       CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS v FROM range(256) r(n))),
v AS MATERIALIZED (SELECT f, xor(list_reduce(list_transform(range(1, strlen(f) + 1),
         lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i - 1, 2) AS BIGINT)),
         lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS k
       FROM (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)), t),
s AS (SELECT k, count(*) AS s FROM df JOIN v USING (f) GROUP BY k),
u AS (SELECT k, count(*) AS t FROM bf JOIN v USING (f) GROUP BY k),
n AS (SELECT (SELECT sum(s) FROM s) AS ns, coalesce((SELECT sum(t) FROM u), 0) AS nt),
g AS (SELECT k, CAST(floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(ns + 10000 AS DOUBLE)
        / (CAST(s + 1 AS DOUBLE) * CAST(nt + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN u USING (k), n),
w AS (SELECT id, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM df JOIN v USING (f) JOIN g USING (k) GROUP BY id),
o AS (SELECT id AS doc_id, n_words, CAST(len(f) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
               / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN w USING (id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM o WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT 25 * count(*) // 100 FROM r) THEN rank END AS rank
FROM o LEFT JOIN r USING (doc_id)
"""


QUERIES = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_cover_tree": (op2_cover_tree, OP2_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_pieces": (op4_pieces, None),
    "op5_line_dedup": (op5_line_dedup, OP5_SQL),
    "op6_minhash": (op6_minhash, OP6_SQL),
    "op7_exact_dedup": (op7_exact_dedup, OP7_SQL),
    "op8_language_model": (op8_language_model, None),
    "op9_suffix_array": (op9_suffix_array, None),
    "op10_mixing": (op10_mixing, None),
    "op11_threshold_negatives": (op11_threshold_negatives, OP11_SQL),
    "op12_discriminant": (op12_discriminant, None),
    "op13_resample": (op13_resample, OP13_SQL),
}
