import hashlib
import itertools
import random
from functools import partial

import duckdb
import pytest
from checking import leaves
from pyspark.sql import functions as F

from kinfold.examples import people
from kinfold.functions import dates
from kinfold.operators import identity, joins, resolve
from kinfold.plans.people import fill_birth_dates, resolve_people, unify_profiles

JW = duckdb.connect()


def jw(a, b):
    return round(JW.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchall()[0][0], 6)


@pytest.mark.parametrize("threshold", [0.5, 0.75, 0.85, 0.9, 1.0])
def test_similar_spellings_equals_brute_force(spark, threshold):
    random.seed(7)
    names = {"".join(random.choice("abcde1 ") for _ in range(random.randint(1, 9))) for _ in range(250)}
    names |= {"maria", "marian", "mariana", "mairan", "m", "x" * 40, "x" * 39 + "y", ""}
    vocab = [(random.choice(["P", "Q"]), n) for n in sorted(names)]
    got = {tuple(r) for r in resolve.similar_spellings(
        spark.createDataFrame(vocab, "blk string, name string"), "blk", "name", threshold).collect()}
    want = set()
    for (b1, n1), (b2, n2) in itertools.combinations(vocab, 2):
        if b1 == b2 and n1 and n2:
            a, b = sorted([n1, n2])
            if jw(a, b) >= threshold:
                want.add((b1, a, b, jw(a, b)))
    assert got == want


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops"])
def test_components(spark, shape):
    random.seed(11)
    ids = list(range(200))
    random.shuffle(ids)
    edges = {"path": list(zip(ids, ids[1:])),
             "star": [(ids[0], x) for x in ids[1:]],
             "random": [(random.choice(ids), random.choice(ids)) for _ in range(170)],
             "loops": [(5, 5), (1, 2), (2, 1), (2, 3), (9, 9)]}[shape]
    got = dict(map(tuple, resolve.connected_components(
        spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert got == union_find(edges)


def test_components_of_nothing(spark):
    assert resolve.connected_components(
        spark.createDataFrame([], "src string, dst string")).count() == 0


PEOPLE = [
    # near copies above both thresholds, a chain through the middle one
    ("k1", "p1", "Maria", "Gonzales", "1980-01-01"), ("k2", "p2", "Mariia", "Gonzalez", "1980-01-01"),
    ("k3", "p3", "Máriia", "Gonsalez", "1980-01-01"),
    # the same person twice, exact copy
    ("k4", "p4", "MARIA", "Gonzales", "1980-01-01"),
    # same block, too different
    ("k5", "p5", "Merio", "Gonzales", "1980-01-01"),
    # other birth date: another block
    ("k6", "p6", "Maria", "Gonzales", "1981-01-01"),
    # unknown and masked birth dates meet as the null token
    ("k7", "p7", "Pedro", "Santos", None), ("k8", "p8", "Pedroo", "Santos", "19xx-xxx"),
    # 9999 matches literally
    ("k9", "p9", "Lucia", "Reyes", "9999-12-31"), ("k10", "p10", "Luciaa", "Reyes", "9999-12-31"),
    # placeholders, null names, null member, quarantined block
    ("k11", "p11", "TBA", "Gonzales", "1980-01-01"), ("k12", "p12", None, "Gonzales", "1980-01-01"),
    ("k13", None, "Maria", "Gonzales", "1980-01-01"), ("k14", "p14", "Tebo", "Paxo", "1980-01-01"),
    # a null key and one key under two names of a block
    (None, "p15", "Maria", "Gonzalesz", "1980-01-01"),
    ("k16", "p16", "Jose", "Rizal", "1990-02-02"), ("k16", "p17", "Josse", "Rizall", "1990-02-02"),
    # jr rewrite, honorific, two-word first name
    ("k18", "p18", "jr Juan", "Cruz", "2000-01-01"), ("k19", "p19", "Mr. Juan Carlo", "Cruz", "2000-01-01"),
    ("k20", "p20", "Juan Carlo", "Cruz", "2000-01-01"),
]
SCHEMA = ("ProvisionalPrimaryKey string, PassengerID string, FirstName string, LastName string, "
          "DateOfBirth string")


def brute_force(people):
    """Blocks, pairs and components by loops over the standardised rows."""
    rows = [r.asDict() for r in people.collect()]
    rows = [r for r in rows if not (r["p_first"] == "TV" and r["p_last"] in ("TV", "PX"))]
    nodes = {}
    for r in rows:
        nodes.setdefault((r["p_first"], r["p_last"], r["dob"], r["first"], r["last"]), []).append(r)
    edges, used = [], set()
    for a, b in itertools.permutations(nodes, 2):
        if a[:3] == b[:3] and min(r["member"] for r in nodes[a]) != min(r["member"] for r in nodes[b]):
            used.add(a)
            if jw(a[3], b[3]) >= 0.85 and jw(a[4], b[4]) >= 0.9:
                edges.append(((a[:2], nodes[a][0]["key"]), (b[:2], nodes[b][0]["key"])))
    for n in used:
        edges += [((n[:2], nodes[n][0]["key"]), (n[:2], r["key"])) for r in nodes[n]]
    root = union_find(edges)
    return {(hashlib.md5("".join(block).encode()).hexdigest(), key,
             hashlib.md5(root[(block, key)][1].encode()).hexdigest()) for block, key in root}


def test_resolution_equals_brute_force(spark):
    profiles = spark.createDataFrame(PEOPLE, SCHEMA)
    found = resolve_people(profiles)
    got = {tuple(r) for r in found.clusters.collect()}
    want = brute_force(resolve.standardise_people(profiles))
    assert got == want
    by_key = {k: h for _, k, h in got}
    assert by_key["k1"] == by_key["k2"] == by_key["k4"] and by_key["k7"] == by_key["k8"]
    assert "k9" not in by_key and "k6" not in by_key
    assert [r["key"] for r in found.quarantined.collect()] == ["k14"]


def test_resolution_of_random_people(spark):
    random.seed(5)
    firsts = ["maria", "marria", "mario", "mariana", "pedro", "pedrro", "petro"]
    lasts = ["santos", "santoss", "santo", "sanntos", "reyes", "reies"]
    people = [(random.choice([f"k{i}", f"k{i % 40}", None]) if i % 9 == 0 else f"k{i}", f"p{i}",
               random.choice(firsts), random.choice(lasts), random.choice(["1980-01-01", None]))
              for i in range(200)]
    profiles = spark.createDataFrame(people, SCHEMA)
    got = {tuple(r) for r in resolve_people(profiles).clusters.collect()}
    assert got == brute_force(resolve.standardise_people(profiles))


def test_birth_date_imputation_is_optional(spark):
    people = spark.createDataFrame(
        [("k1", "p1", "Maria", "Reyes", "1980-01-01"), ("k2", "p2", "Maria", "Reyes", None),
         ("k3", "p3", "Jose", "Reyes", "1900-01-01"), ("k4", "p4", "Jose", "Reyes", None)], SCHEMA)
    filled = fill_birth_dates(resolve.standardise_people(people))
    assert {r["key"]: r["dob"] for r in filled.collect()} == \
        {"k1": "1980-01-01", "k2": "1980-01-01", "k3": "1900-01-01", "k4": "1900-01-01"}


def test_identity_invariants(spark):
    profiles = spark.createDataFrame(PEOPLE, SCHEMA)
    unified = unify_profiles(profiles, resolve_people(profiles).clusters)
    out = unified.profiles
    assert out.count() == len(PEOPLE)
    m = identity.quality_metrics(out).first().asDict()
    assert m["n_without_id"] == 0 and m["n_ambiguous"] == 0 and m["n_rows"] == len(PEOPLE)
    ids = {r["ProvisionalPrimaryKey"]: r["passenger_hash"] for r in out.collect()}
    assert ids["k1"] == ids["k4"] == ids["k13"]     # same name and date, with or without member
    assert ids["k1"] != ids["k6"]
    # fallback ids repeat from run to run
    again = unify_profiles(profiles, resolve_people(profiles).clusters).profiles
    assert {r["ProvisionalPrimaryKey"]: r["passenger_hash"] for r in again.collect()} == ids


def test_carry_over(spark):
    def profile(key, first, last, dob, pid):
        return (key, key, first, last, dob, pid)
    schema = SCHEMA + ", passenger_hash string"
    old = spark.createDataFrame([
        ("MR", "santos", "1980-01-01", "old_a"), ("MR", "santos", "1980-01-01", "old_b"),
        ("JS", "rzl", "1990-01-01 ", "old_c")],
        "pFirstName string, pLastName string, DateOfBirth string, passenger_hash string")
    new = spark.createDataFrame([
        profile("1", "Maria", "Santos", "1980-01-01", "n1"), profile("2", "Maria", "Santos", "1999-09-09", "n2"),
        profile("3", "Ana", "Nueva", "1970-01-01", "n3"), profile("4", "Maria", None, None, "n1"),
        profile(None, "Ana", "Nueva", "1970-01-01", "n3")], schema)
    keys = {(r["ProvisionalPrimaryKey"], r["pFirstName"], r["pLastName"])
            for r in identity.index_rows(new).collect()}
    assert ("1", "MR", "snts") in keys
    old = old.withColumn("pLastName", F.when(F.col("pLastName") == "santos", "snts")
                         .otherwise(F.col("pLastName")))
    renewed, fresh = identity.carry_over(new, old)
    got = sorted((str(r["ProvisionalPrimaryKey"]), r["passenger_hash"]) for r in renewed.collect())
    assert got == [("1", "old_b"), ("2", "n2"), ("3", "n3"), ("4", "old_b"), ("None", "n3")]
    assert {(r["DateOfBirth"], r["passenger_hash"]) for r in fresh.collect()} == \
        {("1999-09-09", "n2"), ("1970-01-01", "n3")}


def test_components_extended_by_new_edges(spark):
    """Equal to a run over all edges; only the contracted new ones are searched."""
    rng = random.Random(11)
    for n, cut in ((90, 60), (40, 0)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(n)] + [(5, 5), (None, 3), (3, None)]
        frame = lambda e: spark.createDataFrame(e, "src long, dst long")
        known = resolve.connected_components(frame(edges[:cut])).checkpoint()
        found = resolve.extend_components(known, frame(edges[cut:]))
        want = union_find([tuple(x if x is not None else max(filter(None, e)) for x in e) for e in edges])
        assert {r.vertex: r.component for r in found.rows.collect()} == want
        full = resolve.find_components(frame(edges))
        assert {r.vertex: r.component for r in full.rows.collect()} == want
        assert found.edges <= n - cut and found.edges <= full.edges and found.rounds <= full.rounds + 1


def test_a_star_settles_in_one_round(spark):
    edges = spark.range(1, 500).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    found = resolve.find_components(edges)
    assert found.rounds == 1 and found.rows.filter("component <> 0").count() == 0


def test_near_dates(spark):
    days = ["1980-01-01", "1980-01-10", "1980-10-01", "1981-01-01", "1908-01-01", "198-01-01", "1980-1-01", "1980-01-12", "1990-02-01",
            None, "unknown", "1980-01", "1980-01-01 ", "2080-01-01", "1980-12-01"]
    df = spark.createDataFrame([(k, d) for k in (1, 2) for d in days], "k int, d string").filter("k = 1 or d < '1980-01-10'")

    def edit(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return a == b
        cut = lambda x: {x[:i] + x[i + 1:] for i in range(len(x))}
        if len(a) != len(b):
            return a in cut(b) or b in cut(a)
        diff = [i for i in range(len(a)) if a[i] != b[i]]
        return len(diff) == 1 or (len(diff) == 2 and diff[1] == diff[0] + 1 and a[diff[0]] == b[diff[1]] and a[diff[1]] == b[diff[0]])
    want = set()
    for k in (1, 2):
        own = sorted({r.d.strip() for r in df.filter(f"k = {k} and d is not null").collect() if r.d.count("-") == 2})
        for a, b in itertools.combinations(own, 2):
            pa, pb = a.split("-"), b.split("-")
            off = [i for i in range(3) if pa[i] != pb[i]]
            if len(off) == 1 and edit(pa[off[0]], pb[off[0]]):
                want.add((k, a, b, ("year", "month", "day")[off[0]]))
    assert {tuple(r) for r in dates.near_dates(df, "d", ("k",)).collect()} == want and len(want) > 10


def test_resolution_with_near_dates(spark):
    people = [("k1", "p1", "Maria", "Reyes", "1980-01-12"), ("k2", "p2", "Mariia", "Reyes", "1980-01-21"),
              ("k3", "p3", "Maria", "Reyes", "1980-10-21"), ("k4", "p4", "Maria", "Reyes", "1975-06-06"),
              ("k5", "p5", "Pedro", "Cruz", "1990-01-01"), ("k6", "p6", "Pedro", "Cruz", None)]
    profiles = spark.createDataFrame(people, SCHEMA)
    strict = {r.provisionalprimarykey for r in resolve_people(profiles).clusters.collect()}
    assert strict == set()
    found = resolve_people(profiles, resolve.PersonSpec(near_dates=True))
    ids = {r.provisionalprimarykey: r.passenger_hash for r in found.clusters.collect()}
    assert ids["k1"] == ids["k2"] == ids["k3"] and ids["k4"] != ids["k1"] and ids["k5"] != ids["k6"]


def test_quality_metrics_in_one_shuffle_of_people(spark):
    df = spark.createDataFrame(
        [("a", "b", "d", "1"), ("a", "b", "d", "2"), ("a", "b", "d", None), ("a", "b", None, "1"), ("a", "b", None, "1"),
         (None, None, None, None), (None, None, None, "3"), ("c", "d", "e", None)],
        "FirstName string, LastName string, DateOfBirth string, passenger_hash string")
    out = identity.quality_metrics(df)
    assert out.first().asDict() == {"n_rows": 8, "n_people": 4, "n_without_id": 3, "n_ambiguous": 1, "n_ids": 3}
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(FirstName") == 1
    assert identity.quality_metrics(df.limit(0)).first().asDict() == {
        "n_rows": 0, "n_people": 0, "n_without_id": 0, "n_ambiguous": 0, "n_ids": 0}


def test_carried_rows_hold_what_is_read(spark, tmp_path):
    from kinfold.examples import people
    spark.createDataFrame([(1, "ann lee bob ray", "en", "src1"), (2, "ann lee", "en", "src2")],
                          "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1,)], "doc_id long").write.parquet(f"{tmp_path}/labels.parquet")
    renewed = people._carried(spark, str(tmp_path))[0]
    assert not {"PassengerID", "doc_id"} & set(renewed.columns)
    assert renewed.count() == 1


def test_name_rules_run_in_a_projection(spark):
    rows = spark.createDataFrame([("a",)], "w string")
    plan = resolve.once(rows, ["w"], up=F.upper("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline(array(_made" in plan and plan.count("upper(") == 1


def test_rows_are_kept_without_the_group_hash(spark):
    people = spark.createDataFrame(
        [("1", "1", "maria", "lopez", "1980-01-01"), ("2", "2", "mario", "lopez", "1980-01-01"),
         ("0", "0", "maria", "lopez", "1980-01-02"), ("1", "9", "maria", "lopez", "1980-01-02"),
         ("5", "5", "mario", "lopez", "1980-01-02")],
        "ProvisionalPrimaryKey string, PassengerID string, FirstName string, LastName string, DateOfBirth string")
    found = resolve_people(people)
    assert "group_hash" not in found.held[0].columns
    block = hashlib.md5(b"MRLPS").hexdigest()
    # key 1 has two identities and joins both days
    assert sorted(map(tuple, found.clusters.collect())) == [
        (block, key, hashlib.md5(b"0").hexdigest()) for key in "0125"]
    found.release()


@pytest.mark.parametrize("crowd", [1, 2, 1000])
def test_ambiguous_people_counts_ids_of_few(spark, monkeypatch, crowd):
    monkeypatch.setattr(identity, "CROWD", crowd)
    asked = []
    every = identity.identities_per_person
    monkeypatch.setattr(identity, "identities_per_person", lambda rows, spec: asked.append(rows) or every(rows, spec))
    rows = ([("a", None, "d", f"{i % 2}") for i in range(9)] + [("b", "x", None, f"{i}") for i in range(5)]
            + [("c", "x", "d", f"{i}") for i in range(4)] + [("d", "x", "d", None)] * 3)
    profiles = spark.createDataFrame(rows, "FirstName string, LastName string, DateOfBirth string, passenger_hash string")
    got = [tuple(r) for r in identity.ambiguous_people(profiles, top=2).collect()]
    assert got == [("b", "x", None, 5, 5, 0), ("c", "x", "d", 4, 4, 0)]
    assert asked[0].count() == (21 if crowd == 1000 else 14)     # the crowd's rows only
    assert len(asked) == (1 if crowd == 1000 else 2)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_marks_of_spellings_are_stored_once(spark):
    vocab = spark.createDataFrame([("P", "maria"), ("P", "marian"), ("P", "maria")], "blk string, name string")
    plan = plan_of(resolve.similar_spellings(vocab, "blk", "name", 0.85))
    assert "array_sort" not in plan and "array_position" not in plan


def test_every_spelling_pair_is_scored_once(spark):
    nodes = spark.createDataFrame(
        [("P", "Q", "1980-01-01", "h", f, "lopez", k, k) for k, f in (("1", "maria"), ("2", "marian"), ("3", "jo"))],
        "p_first string, p_last string, dob string, group_hash string, first string, last string, member string, rep string")
    pairs = resolve.matched_pairs(nodes)
    assert plan_of(pairs).count("ArrowEvalPython") + plan_of(pairs).count("BatchEvalPython") == 2
    assert [(r["first"], r["first_right"]) for r in pairs.collect()] == [("maria", "marian")]


def test_score_pairs_leaves_out_who_has_no_partner(spark, tmp_path):
    from kinfold.examples import people
    spark.createDataFrame([(1, "Maria Lopez Mario Lopez Uwe Kranz", "en", "a"), (2, None, "en", "a")],
                          "doc_id long, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    pairs = people.score_pairs(spark, str(tmp_path))
    assert "LeftSemi" in spark._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "extended")
    assert [(r["first"], r["first_right"]) for r in pairs.collect()] == [("maria", "mario")]


def test_identity_by_hashes_without_counting_names(spark, monkeypatch):
    rnd = random.Random(5)
    names = ["Ann", "ANN", "Bo", "", None]
    people = [(f"k{i % 900}" if i % 50 else None, "Hot" if i % 2 else rnd.choice(names), rnd.choice(names),
               rnd.choice(["1980-01-01", None])) for i in range(1000)]
    ids = [(f"k{i}", rnd.choice([f"id{i}", None])) for i in range(0, 900, 3)] * 2
    rows = spark.createDataFrame(people, "ProvisionalPrimaryKey string, FirstName string, LastName string, DateOfBirth string")
    clusters = spark.createDataFrame(ids, "provisionalprimarykey string, passenger_hash string")

    def fold(f, last, d):
        return ((f or "Unknown") if f is None else f.lower(), "Unknown" if last is None else last.lower(), d or "None")
    best: dict = {}
    for key, *person in people:
        for k, h in ids:
            if key == k and h is not None:
                best[fold(*person)] = max(h, best.get(fold(*person), ""))
    null = identity.fixed.NULL_TOKEN
    want = sorted((str(k), str(best.get(fold(f, last, d)) or hashlib.md5("_".join(
        [*fold(f, last, d)[:2], d or null]).encode()).hexdigest())) for k, f, last, d in people)

    def refuse(*_, **__):
        raise AssertionError("a pass over all rows counts names")
    monkeypatch.setattr(joins, "heavy_keys", refuse)
    short = partial(joins.attach_hashed, rows_per_salt=20)      # some names are salted
    for attach in (joins.attach_hashed, short):
        monkeypatch.setattr(identity, "attach_hashed", attach)
        out = identity.assign_identity(rows, clusters)
        assert sorted((str(r["ProvisionalPrimaryKey"]), r["passenger_hash"]) for r in out.collect()) == want


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_join_hashed_equals_plain(spark, kind):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k bigint, x string")
    right = spark.createDataFrame([("1", 5), ("1", 6), ("3", 7), (None, 8)], "k string, y int").withColumn("k", F.col("k").cast(kind))
    assert sorted(joins.join_hashed(left, right, "k").collect()) == sorted(left.join(right, "k").collect())


def test_name_rules_of_the_index_run_once_per_person(spark):
    people = [("k1", "Maria", "Lopez", "1980-01-01", "i1"), ("k2", "Maria", "Lopez", "1980-01-01", "i1"),
              ("k3", "Maria", "Lopez", "1980-01-01", "i2"), (None, "MARIA", "Lopez", "1980-01-01", "i1"),
              ("k5", None, "Lopez", "1980-01-01", "i1"), ("k6", "Maria", "Lopez", None, "i1"), ("k7", "Maria", "Lopez", "1980-01-01", None)]
    profiles = spark.createDataFrame(people, "ProvisionalPrimaryKey string, FirstName string, LastName string, DateOfBirth string, passenger_hash string")
    index = identity.identity_index(profiles)
    by_row = identity.index_rows(profiles).drop("ProvisionalPrimaryKey")
    assert sorted(map(str, index.collect())) == sorted({str(r) for r in by_row.collect()}) and index.count() == 3
    assert index.columns == by_row.columns and index.schema == by_row.schema
    plan = plan_of(index)
    assert plan.count("Aggregate") == 2 and plan.rindex("Aggregate") > plan.rindex("Generate")     # below the rules


@pytest.mark.parametrize("query, most", [("unify_people", 4), ("score_pairs", 12), ("new_identities", 9)])
def test_people_leave_few_shuffle_files(spark, query, most):
    """What earlier steps shuffled is gone from the disk when the last one runs."""
    assert leaves(spark, lambda: people.QUERIES[query][0](spark, "/root/testdata/sf0.001")) <= most


def test_attach_hashed_finds_its_heavy_keys(spark):
    """Without a list the keys are counted by hash; keys may be expressions over the left rows."""
    left = spark.createDataFrame([("A" if i % 3 else "b", i) for i in range(90)] + [(None, 90), ("z", 91)], "k string, i int")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("q", 3), (None, 4)], "low string, n int")
    got = joins.attach_hashed(left, right, {"low": F.lower("k")}, rows_per_salt=20)
    want = left.join(right, F.lower("k") == F.col("low"), "left").drop("low")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_clusters_of_repeated_keys(spark):
    """A key with two identities links them; equal rows give one row, empty names none."""
    rows = [("1", "maria", "reyes"), ("1", "maria", "reyes"), ("2", "mariia", "reyes"), ("3", "berta", "ruiz"),
            ("3", "berto", "ruiz"), ("4", "berto", "ruiz"), ("5", "", "ruiz"), ("6", "carla", "soto")]
    df = spark.createDataFrame([(k, k, f, last, None) for k, f, last in rows],
                               "ProvisionalPrimaryKey string, PassengerID string, FirstName string, LastName string, DateOfBirth string")
    found = resolve_people(df)
    got = [(r.provisionalprimarykey, r.passenger_hash) for r in found.clusters.collect()]
    found.release()
    ids = dict(got)
    assert len(got) == len(set(got)) and "5" not in ids and "6" not in ids
    assert ids["1"] == ids["2"] and ids["3"] == ids["4"] != ids["1"]
