"""Entity resolution and identity over people read from whole texts, with check SQL.

A text is a list of people: words 1 and 2 are the first person's first and last
name, words 3 and 4 the second's, and so on to its end (an odd last word has no
last name).  The language decides what is known of the birth date.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import fixed
from ..functions import dates, scripts, text
from ..operators import identity, resolve

from ..plans import people as stages
from ..session import discard, stored
from .tables import spread, table

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return keep


# --- people -------------------------------------------------------------------------

def mentions(spark, sf):
    words = F.split(F.trim(F.regexp_replace("text", "[ \\t\\r\\n]+", " ")), " ")
    docs = spread(table(spark, sf, "documents")).select(
        "doc_id", "lang", "source", words.alias("w"))
    last = F.greatest(F.lit(0), F.ceil(F.size("w") / 2).cast("int") - 1)
    rows = docs.select("*", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    dob = (F.when(F.col("lang") == "en", "1980-01-01").when(F.col("lang") == "fr", "9999-12-31")
            .when(F.col("lang") == "es", "19xx-xxx"))
    key = F.concat_ws("_", "doc_id", "i")
    return rows.select(
        key.alias("ProvisionalPrimaryKey"), key.alias("PassengerID"),
        F.get("w", 2 * F.col("i")).alias("FirstName"),
        F.get("w", 2 * F.col("i") + 1).alias("LastName"),
        dob.alias("DateOfBirth"), "source", "doc_id")


MENTIONS = r"""
docs AS (SELECT doc_id, lang, source,
   string_split(trim(regexp_replace(text, '[ \t\r\n]+', ' ', 'g')), ' ') AS w FROM documents),
spots AS MATERIALIZED (SELECT *, unnest(range(greatest(1, cast(ceil(len(w) / 2.0) AS BIGINT)))) AS i FROM docs),
mentions AS (SELECT doc_id || '_' || i AS key, w[2 * i + 1] AS first_name, w[2 * i + 2] AS last_name,
   CASE lang WHEN 'en' THEN '1980-01-01' WHEN 'fr' THEN '9999-12-31' WHEN 'es' THEN '19xx-xxx' END AS dob,
   source, doc_id FROM spots)"""


def ascii_sql(c: str) -> str:
    out = f"strip_accents({c})"
    for a, b in (("ß", "ss"), ("Æ", "AE"), ("æ", "ae"), ("Œ", "OE"), ("œ", "oe"), ("ø", "o")):
        out = f"replace({out}, '{a}', '{b}')"
    return f"coalesce({out}, 'xxx')"


def name_sql(c: str, spaces: bool) -> str:
    keep = "[^a-zA-Z0-9 ]" if spaces else "[^a-zA-Z0-9]"
    return f"lower(regexp_replace({ascii_sql(c)}, '{keep}', '', 'g'))"


def bare_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '^({'|'.join(fixed.HONORIFICS)})', ''))"


# Spanish Metaphone one letter rule at a time, without look-around: what a rule
# emits is lower case, so no later rule reads it.  (pattern, emitted, is regex)
METAPHONE_STEPS = (
    [("CH", "X", False), ("B", "V", False), ("Z", "S", False), ("LL", "Y", False)]
    + [(f"^{v}", v.lower(), True) for v in "AEIOU"]
    + [("^S([^AEIOU])", r"es\1", True), ("^X([^AEIOU])", r"ex\1", True)]
    + [(ch * 2, ch, False) for ch in "DFJKMNPTVLY"]
    + [("CC", "x", False), ("C[EI]", "z", True), ("C", "k", False)]
    + [("G[EI]", "j", True), ("G", "g", False)]
    + [(f"H{v}", v.lower(), False) for v in "AEIOU"] + [("H", "h", False)]
    + [("QU", "k", False), ("Q", "k", False), ("W", "u", False)])


def phonetic_sql(c: str) -> str:
    out = f"upper({c})"
    for pattern, emitted, is_regex in METAPHONE_STEPS:
        out = (f"regexp_replace({out}, '{pattern}', '{emitted}', 'g')" if is_regex
               else f"replace({out}, '{pattern}', '{emitted}')")
    copied = "DFJKMNPTVLYRSX"
    out = f"translate({out}, '{copied}', '{copied.lower()}')"
    code = f"substring(upper(regexp_replace({out}, '[^a-z]', '', 'g')), 1, 6)"
    return f"coalesce(CASE WHEN length({c}) > 3 THEN {code} ELSE {c} END, '{fixed.NULL_TOKEN}')"


def in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# One row per distinct name first, so that the long rule chain runs once per name.
PEOPLE = MENTIONS + f""",
named AS MATERIALIZED (SELECT key, {name_sql("first_name", True)} AS f, {name_sql("last_name", False)} AS l,
   coalesce(CASE WHEN dob LIKE '%xxx%' THEN '{fixed.NULL_TOKEN}' ELSE dob END, '{fixed.NULL_TOKEN}') AS dob
   FROM (SELECT * REPLACE (CASE WHEN first_name = 'Unknown' THEN '{fixed.NULL_TOKEN}' ELSE first_name END
         AS first_name) FROM mentions)),
real AS MATERIALIZED (SELECT * FROM named WHERE replace(f, ' ', '') NOT IN ({in_list(fixed.FIRST_NAME_PLACEHOLDERS)})
   AND l NOT IN ({in_list(fixed.LAST_NAME_PLACEHOLDERS)})),
first_keys AS (SELECT f, bare, trim({phonetic_sql("tok")}) AS code FROM
   (SELECT f, bare, string_split(bare, ' ')[1] AS tok FROM
     (SELECT f, {bare_sql("f")} AS bare FROM (SELECT DISTINCT f FROM real)))),
last_keys AS (SELECT l, trim({phonetic_sql("l")}) AS code FROM (SELECT DISTINCT l FROM real)),
people AS MATERIALIZED (SELECT *, md5(p_first || p_last) AS group_hash FROM
  (SELECT key, key AS member, regexp_replace(r.f, '^jr', ' junior alias son of jr') AS first,
    r.l AS last, dob,
    CASE WHEN dob LIKE '9999%' THEN k.bare ELSE k.code END AS p_first,
    CASE WHEN dob LIKE '9999%' THEN r.l ELSE j.code END AS p_last
   FROM real r JOIN first_keys k ON r.f = k.f JOIN last_keys j ON r.l = j.l))"""

NODES = PEOPLE + """,
sane AS MATERIALIZED (SELECT * FROM people WHERE NOT (p_first IN ('TV') AND p_last IN ('TV', 'PX'))),
nodes AS MATERIALIZED (SELECT group_hash, p_first, p_last, dob, first, last, min(key) AS rep,
   min(member) AS member, count(*) AS n_rows FROM sane
   WHERE first <> '' AND last <> '' AND p_first <> '' AND p_last <> '' GROUP BY ALL)"""

# Each pair of spellings is scored once, not once per pair of nodes that bear them.
PAIRS = NODES + """,
first_words AS MATERIALIZED (SELECT DISTINCT p_first, first FROM nodes),
last_words AS MATERIALIZED (SELECT DISTINCT p_last, last FROM nodes),
first_pairs AS MATERIALIZED (SELECT * FROM (SELECT a.p_first, a.first, b.first AS first_right,
  round(jaro_winkler_similarity(a.first, b.first), 6) AS first_score
  FROM first_words a JOIN first_words b ON a.p_first = b.p_first AND a.first <= b.first) WHERE first_score >= 0.85),
last_pairs AS MATERIALIZED (SELECT * FROM (SELECT a.p_last, a.last, b.last AS last_right,
  round(jaro_winkler_similarity(a.last, b.last), 6) AS last_score
  FROM last_words a JOIN last_words b ON a.p_last = b.p_last) WHERE last_score >= 0.9),
pairs AS MATERIALIZED (
  SELECT a.p_first, a.p_last, a.dob, a.group_hash, a.first, a.last, b.first AS first_right,
   b.last AS last_right, a.rep, b.rep AS rep_right, first_score, last_score
  FROM nodes a JOIN first_pairs f ON f.p_first = a.p_first AND f.first = a.first
  JOIN nodes b ON b.p_first = a.p_first AND b.p_last = a.p_last AND b.dob = a.dob AND b.first = f.first_right
   AND (a.first < b.first OR a.last < b.last)
  JOIN last_pairs l ON l.p_last = a.p_last AND l.last = a.last AND l.last_right = b.last)"""

CLUSTERS = "WITH RECURSIVE " + PAIRS.lstrip() + """,
links AS (SELECT group_hash, rep AS u, rep_right AS v FROM pairs
          UNION SELECT group_hash, rep_right, rep FROM pairs),
reach(group_hash, u, v) AS (
  SELECT group_hash, u, v FROM links
  UNION SELECT r.group_hash, r.u, l.v FROM reach r JOIN links l
    ON r.group_hash = l.group_hash AND r.v = l.u),
roots AS (SELECT group_hash, u AS rep, min(v) AS root FROM reach GROUP BY 1, 2),
partnered AS (SELECT n.* FROM nodes n JOIN (SELECT p_first, p_last, dob FROM nodes
  GROUP BY ALL HAVING min(member) <> max(member)) b USING (p_first, p_last, dob)),
clusters AS (SELECT s.group_hash, s.key AS provisionalprimarykey,
   md5(least(n.rep, coalesce(r.root, n.rep))) AS passenger_hash
  FROM sane s JOIN partnered n ON s.group_hash = n.group_hash AND s.dob = n.dob
   AND s.first = n.first AND s.last = n.last
  LEFT JOIN roots r ON n.group_hash = r.group_hash AND n.rep = r.rep)"""


def people(spark, sf):
    return resolve.standardise_people(mentions(spark, sf))


def nodes(spark, sf):
    kept, _ = stages.split_quarantine(people(spark, sf), stages.quarantine_rule())
    return resolve.collapse_exact(kept)


@query("name_normalise", f"""WITH {MENTIONS}
SELECT key, {name_sql("first_name", True)} AS first, {name_sql("last_name", False)} AS last,
 {bare_sql(name_sql("first_name", True))} AS bare FROM mentions""")
def name_normalise(spark, sf):
    first = text.normalise_name(text.transliterate(F.col("FirstName")), True)
    last = text.normalise_name(text.transliterate(F.col("LastName")), False)
    return mentions(spark, sf).select(
        F.col("ProvisionalPrimaryKey").alias("key"), first.alias("first"), last.alias("last"),
        text.strip_honorific(first).alias("bare"))


# Customer numbers written in twelve scripts; the expected syllables are written by hand.
SCRIPTS = {
    "абвгдежзий": "a b v g d e zh z i y", "αβγδεηθλφψ": "a v g d e i th l f ps",
    "かきくけこシチツヘヴ": "ka ki ku ke ko shi chi tsu he vu", "가난도류을합격빛꽃뛰": "ga nan do ryu eul hap gyeok bit kkot ttwi",
    "אבגדלמנרשת": "a b g d l m n r sh t", "ابتجدرسشمن": "a b t j d r s sh m n", "աբգդզժլկմշ": "a b g d z zh l k m sh",
    "აბგდზლმნრშ": "a b g d z l m n r sh", "कखगघचजटडतप": "ka kha ga gha ca ja ta da ta pa",
    "กขงชดตทนบม": "k kh ng ch d t th n b m", "ሀለመረሰሸቀበተነ": "ha la ma ra sa sha qa ba ta na", "ＡＢＣｘｙｚ１２３９": "a b c x y z 1 2 3 9"}


def _digits_sql(letters: list[str]) -> str:
    items = ", ".join(f"'{x}'" for x in letters)
    return (f"array_to_string(list_transform(string_split(cast(c_custkey AS VARCHAR), ''), "
            f"lambda d: ([{items}])[cast(d AS INTEGER) + 1]), '')")


@query("transliterate_scripts", f"""SELECT c_custkey, CASE c_custkey % {len(SCRIPTS)}
 {" ".join(f"WHEN {i} THEN {_digits_sql(v.split())}" for i, v in enumerate(SCRIPTS.values()))} END AS name
FROM customer""")
def transliterate_scripts(spark, sf):
    digits = F.col("c_custkey").cast("string")
    name = F.lit(None)
    for i, letters in enumerate(SCRIPTS):
        name = F.when(F.col("c_custkey") % len(SCRIPTS) == i, F.translate(digits, "0123456789", letters)).otherwise(name)
    return table(spark, sf, "customer").select(
        "c_custkey", text.normalise_name(text.transliterate(name), False).alias("name"))


# Vowel signs, bare consonants, long marks and half-width kana change the letter before them.
NEIGHBOURS = {"किकीकुकेकोक्कंकौकृक": "ki ki ku ke ko k kan kau kri ka", "ｶﾞｼﾞﾀﾞﾊﾟﾌﾞﾁﾞｳﾞｶｰｼｰｱｰ": "ga ji da pa bu ji vu ka shi a",
              "কিকাকুকেকোক্কংকৈকৃক়": "ki ka ku ke ko k kan kai kri ka"}


@query("transliterate_neighbours", f"""SELECT c_custkey, CASE c_custkey % {len(NEIGHBOURS)}
 {" ".join(f"WHEN {i} THEN {_digits_sql(v.split())}" for i, v in enumerate(NEIGHBOURS.values()))} END AS name
FROM customer""")
def transliterate_neighbours(spark, sf):
    def written(letters):
        # a letter with its sign: the sign is not a letter of its own
        parts = re.findall("[क][\\u0900-\\u094d]?|[ক][\\u0981-\\u09cd]?|[ｦ-ﾝ][ﾞﾟｰ]?", letters)
        items = F.array(*[F.lit(x) for x in parts])
        digits = F.filter(F.split(F.col("c_custkey").cast("string"), ""), lambda d: d != "")
        return F.array_join(F.transform(digits, lambda d: F.get(items, d.cast("int"))), "")
    name = F.lit(None)
    for i, letters in enumerate(NEIGHBOURS):
        name = F.when(F.col("c_custkey") % len(NEIGHBOURS) == i, written(letters)).otherwise(name)
    return table(spark, sf, "customer").select(
        "c_custkey", text.normalise_name(text.transliterate(name), False).alias("name"))


# Han has readings only from a table; without one its characters are spelt out.
HAN = dict(zip("〇一二三四五六七八九", "ling yi er san si wu liu qi ba jiu".split()))


@query("transliterate_readings", f"""SELECT c_custkey, {_digits_sql(list(HAN.values()))} AS name,
 'nr ' || c_nationkey AS other FROM customer""")
def transliterate_readings(spark, sf):
    readings = spark.createDataFrame(list(HAN.items()) + [("九", "zz"), (None, "x"), ("x", None)], "char string, latin string")
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.translate(F.col("c_custkey").cast("string"), "0123456789", "".join(HAN)).alias("name"),
        F.concat(F.lit("Nr. "), "c_nationkey").alias("other"))
    read = scripts.with_readings(rows, ["name", "other"], readings)
    return read.select("c_custkey", *[text.normalise_name(text.transliterate(F.col(c)), True).alias(c) for c in ("name", "other")])


STOP_FIRST, STOP_LAST = ["the", "de", "und", "que"], ["of", "la", "der", "el"]


@query("placeholder_filter", f"""WITH {MENTIONS}
SELECT key FROM mentions WHERE lower(first_name) NOT IN ({in_list(STOP_FIRST)})
 AND lower(last_name) NOT IN ({in_list(STOP_LAST)})""")
def placeholder_filter(spark, sf):
    rows = mentions(spark, sf).withColumnRenamed("ProvisionalPrimaryKey", "key")
    return resolve.reject_placeholders(rows, F.lower("FirstName"), F.lower("LastName"),
                                       STOP_FIRST, STOP_LAST).select("key")


@query("phonetic_block", f"WITH {PEOPLE} SELECT * FROM people")
def phonetic_block(spark, sf):
    return people(spark, sf)


@query("exact_collapse", f"WITH {NODES} SELECT * FROM nodes")
def exact_collapse(spark, sf):
    return nodes(spark, sf)


@query("candidate_blocks", f"""WITH {NODES}
SELECT p_first, p_last, dob, count(*) AS n_members, count(*) * (count(*) - 1) // 2 AS n_pairs
FROM nodes GROUP BY 1, 2, 3""")
def candidate_blocks(spark, sf):
    return resolve.block_sizes(nodes(spark, sf))


@query("similar_spellings", f"""WITH {NODES}, v AS (SELECT DISTINCT p_last, last FROM nodes)
SELECT * FROM (SELECT a.p_last, a.last AS a, b.last AS b,
  round(jaro_winkler_similarity(a.last, b.last), 6) AS score
 FROM v a JOIN v b ON a.p_last = b.p_last AND a.last < b.last) WHERE score >= 0.9""")
def similar_spellings(spark, sf):
    vocab = nodes(spark, sf).select("p_last", "last").distinct()
    return resolve.similar_spellings(vocab, "p_last", "last", fixed.LAST_NAME_THRESHOLD)


@query("score_pairs", f"""WITH {PAIRS}
SELECT p_first, p_last, dob, first, last, first_right, last_right, first_score, last_score
FROM pairs""")
def score_pairs(spark, sf):
    # As in the stage: who has no partner in the block never meets the spelling joins.
    everyone = stored(nodes(spark, sf).drop("group_hash"))
    paired = stored(resolve.has_partner(everyone))
    discard(everyone)
    return resolve.matched_pairs(paired).select(
        "p_first", "p_last", "dob", "first", "last", "first_right", "last_right",
        "first_score", "last_score")


@query("components", """
WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS u, -o_custkey - 1 AS v FROM orders
  UNION SELECT DISTINCT c_custkey, -c_nationkey - 100000 FROM customer),
links AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach(u, v) AS (SELECT u, v FROM links
  UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT u AS vertex, least(u, min(v)) AS component FROM reach GROUP BY u""")
def components(spark, sf):
    bought = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("src"), (-F.col("o_custkey") - 1).alias("dst"))
    near = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("src"), (-F.col("c_nationkey") - 100000).cast("bigint").alias("dst"))
    return resolve.connected_components(bought.unionByName(near))


@query("extend_components", """
WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS u, -o_custkey - 1 AS v FROM orders
  UNION SELECT DISTINCT c_custkey, -c_nationkey - 100000 FROM customer WHERE c_custkey % 10 < 7),
links AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
reach(u, v) AS (SELECT u, v FROM links
  UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT u AS vertex, least(u, min(v)) AS component FROM reach GROUP BY u""")
def extend_components(spark, sf):
    """Yesterday: orders, and the nations of some customers; today: the nations of some more."""
    bought = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("src"), (-F.col("o_custkey") - 1).alias("dst"))
    near = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("src"), (-F.col("c_nationkey") - 100000).cast("bigint").alias("dst"))
    turn = F.col("src") % 10
    known = resolve.connected_components(bought.unionByName(near.filter(turn < 4))).checkpoint()
    return resolve.extend_components(known, near.filter((turn >= 4) & (turn < 7))).rows


@query("near_dates", """WITH d AS (SELECT DISTINCT o_orderstatus AS status, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders),
p AS (SELECT status, d, string_split(d, '-') AS p FROM d),
m AS (SELECT a.status, a.d AS a, b.d AS b, list_transform(range(1, 4), lambda i: damerau_levenshtein(a.p[i], b.p[i])) AS e
  FROM p a JOIN p b ON a.status = b.status AND a.d < b.d)
SELECT status, a, b, CASE WHEN e[1] = 1 THEN 'year' WHEN e[2] = 1 THEN 'month' ELSE 'day' END AS part
FROM m WHERE list_sort(e) = [0, 0, 1]""")
def near_dates(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("d"))
    return dates.near_dates(rows, "d", ("status",))


@query("resolve_people", CLUSTERS + "SELECT * FROM clusters")
def resolve_people(spark, sf):
    return stages.resolve_people(mentions(spark, sf)).clusters


# --- identity ----------------------------------------------------------------------------

# Seeds: a mention in a labelled document carries an id; the id spreads by name.
SEEDED = f"""{MENTIONS},
seeded AS MATERIALIZED (SELECT m.*, CASE WHEN b.doc_id IS NOT NULL THEN md5(m.key) END AS seed
  FROM mentions m LEFT JOIN (SELECT DISTINCT doc_id FROM labels) b ON m.doc_id = b.doc_id),
folded AS MATERIALIZED (SELECT *, first_name AS lf,
   coalesce(lower(first_name), 'Unknown') AS f, coalesce(lower(last_name), 'Unknown') AS l FROM seeded),
assigned AS MATERIALIZED (SELECT key, first_name, last_name, dob, source, coalesce(
   max(seed) OVER (PARTITION BY f, l, dob),
   md5(f || '_' || l || '_' || coalesce(dob, '{fixed.NULL_TOKEN}'))) AS passenger_hash FROM folded)"""


# The id of a mention goes to everyone of that name; other people get a fallback.
def _seeds(spark, sf, rows):
    labelled = table(spark, sf, "labels").select("doc_id").distinct()
    return (rows.join(labelled, "doc_id", "left_semi")
            .select(F.col("ProvisionalPrimaryKey").alias("provisionalprimarykey"),
                    F.md5("ProvisionalPrimaryKey").alias("passenger_hash")))


def assigned(spark, sf):
    rows = mentions(spark, sf)
    return identity.assign_identity(rows, _seeds(spark, sf, rows))


@query("assign_identity", f"WITH {SEEDED} SELECT key, passenger_hash FROM assigned")
def assign_identity(spark, sf):
    return assigned(spark, sf).select(F.col("ProvisionalPrimaryKey").alias("key"),
                                      "passenger_hash")


INDEXED = f"""{SEEDED},
eligible AS MATERIALIZED (SELECT key, {name_sql("first_name", True)} AS f, {name_sql("last_name", True)} AS l,
   dob, passenger_hash, source FROM assigned WHERE first_name IS NOT NULL AND last_name IS NOT NULL
   AND dob IS NOT NULL AND dob NOT LIKE '%xxx%'),
real AS MATERIALIZED (SELECT * FROM eligible WHERE
   f NOT IN ({in_list(fixed.FIRST_NAME_PLACEHOLDERS + fixed.INDEX_EXTRA_PLACEHOLDERS)})
   AND l NOT IN ({in_list(fixed.LAST_NAME_PLACEHOLDERS + fixed.INDEX_EXTRA_PLACEHOLDERS)})
   AND f <> '' AND l <> ''),
fk AS (SELECT f, bare, trim({phonetic_sql("tok")}) AS code FROM
   (SELECT f, bare, string_split(bare, ' ')[1] AS tok FROM
     (SELECT f, {bare_sql("f")} AS bare FROM (SELECT DISTINCT f FROM real)))),
lk AS (SELECT l, trim(lower({phonetic_sql("l")})) AS code FROM (SELECT DISTINCT l FROM real)),
observed AS MATERIALIZED (SELECT * FROM (SELECT key, source, CASE WHEN dob LIKE '9999%' THEN fk.bare ELSE fk.code END AS pf,
   CASE WHEN dob LIKE '9999%' THEN r.l ELSE lk.code END AS pl, dob, passenger_hash
   FROM real r JOIN fk ON r.f = fk.f JOIN lk ON r.l = lk.l) WHERE pf <> '' AND pl <> '')"""


@query("identity_index", f"""WITH {INDEXED}
SELECT DISTINCT pf AS pFirstName, pl AS pLastName, dob AS DateOfBirth, passenger_hash
FROM observed""")
def identity_index(spark, sf):
    # As in the stage: from stored rows, when the shuffle files of the assignment are gone.
    everyone = assigned(spark, sf).select("FirstName", "LastName", "DateOfBirth", "passenger_hash")
    return identity.identity_index(stored(everyone))


# Earlier run: the sources below 'src14' (text order); today's run: the others.
CARRIED = f"""{INDEXED},
today AS (SELECT * FROM observed WHERE source >= 'src14'),
old AS (SELECT pf, pl, dob, max(md5(passenger_hash)) AS old_id FROM observed
        WHERE source < 'src14' GROUP BY 1, 2, 3),
overrides AS (SELECT t.passenger_hash, max(old_id) AS old_id FROM today t
  JOIN old o ON t.pf = o.pf AND t.pl = o.pl AND t.dob = o.dob GROUP BY 1)"""


def _carried(spark, sf):
    # Read for the index, the overrides and the result.
    everyone = stored(assigned(spark, sf).drop("PassengerID", "doc_id"))
    old = identity.identity_index(everyone.filter("source < 'src14'"))
    old = old.withColumn("passenger_hash", F.md5("passenger_hash"))
    return identity.carry_over(everyone.filter("source >= 'src14'"), old)


@query("carry_over", f"""WITH {CARRIED}
SELECT key, coalesce(o.old_id, a.passenger_hash) AS passenger_hash FROM assigned a
LEFT JOIN overrides o ON a.passenger_hash = o.passenger_hash WHERE source >= 'src14'""")
def carry_over(spark, sf):
    return _carried(spark, sf)[0].select(F.col("ProvisionalPrimaryKey").alias("key"),
                                         "passenger_hash")


@query("new_identities", f"""WITH {CARRIED}
SELECT DISTINCT pf AS pFirstName, pl AS pLastName, dob AS DateOfBirth, passenger_hash FROM today t
WHERE NOT EXISTS (SELECT 1 FROM old o WHERE t.pf = o.pf AND t.pl = o.pl AND t.dob = o.dob)""")
def new_identities(spark, sf):
    return _carried(spark, sf)[1]


# Ids by document make one name ambiguous whenever two documents mention it.
BY_DOC = f"""{MENTIONS}, ids AS (SELECT first_name, last_name, dob, CASE WHEN source = 'src3'
  THEN NULL ELSE md5(cast(doc_id AS VARCHAR)) END AS id FROM mentions),
each AS (SELECT first_name AS "FirstName", last_name AS "LastName", dob AS "DateOfBirth",
  count(*) AS n_rows, count(DISTINCT id) AS n_ids, count(*) FILTER (WHERE id IS NULL) AS n_without_id
  FROM ids GROUP BY 1, 2, 3)"""


def _by_doc(spark, sf):
    one = F.when(F.col("source") != "src3", F.md5(F.col("doc_id").cast("string")))
    return mentions(spark, sf).withColumn("passenger_hash", one)


@query("quality_metrics", f"""WITH {BY_DOC}
SELECT cast(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_people,
 cast(sum(n_without_id) AS BIGINT) AS n_without_id,
 count(*) FILTER (WHERE n_ids > 1) AS n_ambiguous,
 (SELECT count(DISTINCT id) FROM ids) AS n_ids FROM each""")
def quality_metrics(spark, sf):
    return identity.quality_metrics(_by_doc(spark, sf))


@query("ambiguous_people", f"""WITH {BY_DOC}
SELECT * FROM each WHERE n_ids > 1 ORDER BY n_ids DESC, "FirstName" NULLS FIRST,
 "LastName" NULLS FIRST, "DateOfBirth" NULLS FIRST LIMIT 10""")
def ambiguous_people(spark, sf):
    return identity.ambiguous_people(_by_doc(spark, sf))


@query("unify_people", CLUSTERS + f""",
folded AS MATERIALIZED (SELECT m.key, m.dob, c.passenger_hash AS h, coalesce(lower(first_name), 'Unknown') AS f,
  coalesce(lower(last_name), 'Unknown') AS l
  FROM mentions m LEFT JOIN clusters c ON m.key = c.provisionalprimarykey)
SELECT key, coalesce(max(h) OVER (PARTITION BY f, l, dob),
  md5(f || '_' || l || '_' || coalesce(dob, '{fixed.NULL_TOKEN}'))) AS passenger_hash FROM folded""")
def unify_people(spark, sf):
    """Resolution and assignment end to end."""
    rows = mentions(spark, sf)
    found = stages.resolve_people(rows)
    clusters = stored(found.clusters)
    found.release()
    return stages.unify_profiles(rows, clusters).profiles.select(
        F.col("ProvisionalPrimaryKey").alias("key"), "passenger_hash")
