"""Partitioned sources, sinks and the four stages on disk."""

import copy
import datetime

import pytest
from checking import leaves
from pyspark.sql import functions as F

from kinfold.examples import travel
from kinfold.operators import serve
from kinfold.plans import serving
from kinfold.plans.stages import Stages
from kinfold.sources import partitions, sinks

SF = "/root/testdata/sf0.001"


def write(df, base, column, date, fmt="parquet"):
    df.write.mode("append").format(fmt).save(f"{base}/{column}={date}")


@pytest.fixture
def entity(spark, tmp_path):
    base = f"{tmp_path}/source_open/all_booking"
    e = partitions.Entity.from_config(
        {"entityName": "all_booking", "pathUrl": base, "dataFormat": "orc"},
        ["BookingID"], stored_fmt="orc")
    def rows(*ids, op="D", end="9999-12-31 00:00:00.000"):
        return spark.createDataFrame([(i, op, end, "x") for i in ids],
                                     "BookingID int, c_operationtype string, VersionEndUTC string, other string")
    write(rows(1), e.open_path, "ods", "2021-01-01", "orc")
    write(rows(2), e.open_path, "ods", "2023-07-31", "orc")
    write(rows(99), e.open_path, "ods", "2022-02-02", "orc")
    write(rows(3), e.closed_path, "nds", "2021-05-05", "orc")
    write(rows(4, op="A"), e.closed_path, "nds", "2021-05-05", "orc")
    write(rows(5, end="2022-01-01"), e.closed_path, "nds", "2023-07-31", "orc")
    write(rows(6), e.closed_path, "nds", "2023-08-01", "orc")
    write(rows(7), e.stored_path, "vds", "2023-07-01", "orc")
    write(rows(8, op=None), e.stored_path, "vds", "2023-07-01", "orc")
    write(rows(9, op="A"), e.stored_path, "vds", "2023-07-01", "orc")
    write(rows(10), e.stored_path, "vds", "2023-06-01", "orc")
    return e


def ids(df):
    return sorted(r["BookingID"] for r in df.collect())


def test_paths(entity):
    assert entity.closed_path.endswith("source_nonopen/all_bookingversion")
    assert entity.stored_path.endswith("source_storage/all_booking")


def test_paths_of_the_config_win():
    e = partitions.Entity.from_config({"entityName": "a", "pathUrl": "s3://open/a", "dataFormat": "orc",
                                       "closedPathUrl": "s3://c/a", "storedPathUrl": "s3://d/a"})
    assert (e.open_path, e.closed_path, e.stored_path) == ("s3://open/a", "s3://c/a", "s3://d/a")
    assert partitions.beside("/open/x_open/all_open", "nonopen") == "/open/x_nonopen/all_open"
    with pytest.raises(ValueError):
        partitions.beside("/data/all_booking", "storage")


def test_snapshots_and_closed(spark, entity):
    df = partitions.load_snapshots(spark, entity, "2023-07-31", "2021-01-01", tagged=True)
    assert sorted(map(tuple, df.collect())) == [(1, "Archive"), (2, "Open")]
    assert ids(partitions.load_snapshots(spark, entity, "2023-07-31", "1999-01-01")) == [2]
    assert ids(partitions.load_closed(spark, entity, "2021-01-01", "2023-07-31")) == [3, 5]
    assert ids(partitions.load_closed(spark, entity, "2021-01-01", "2023-07-31", True)) == [3]


def test_increments(spark, entity):
    assert ids(partitions.load_increment(spark, entity, "2023-07-01", "2023-07-31")) == [7]
    assert ids(partitions.load_increment(spark, entity, "2023-06-15", "2023-06-20")) == [10]
    assert ids(partitions.changed_rows(spark, entity, "2023-07-01", "2023-07-31")) == [9]


def test_partition_pruning_and_pushdown(spark, entity):
    plan = partitions.load_closed(spark, entity, "2021-01-01", "2021-12-31") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(nds" in plan and "PushedFilters: [IsNotNull(c_operationtype)" in plan
    assert "other" not in plan


def test_write_stage_replaces_one_date(spark, tmp_path):
    base = f"{tmp_path}/stage"
    df = spark.range(5)
    sinks.write_stage(df, base, "2024-01-01", max_records=2)
    sinks.write_stage(df, base, "2024-01-02")
    sinks.write_stage(spark.range(3), base, "2024-01-02")
    assert partitions.read_stage(spark, base, "2024-01-01").count() == 5
    assert partitions.read_stage(spark, base, "2024-01-01", "2024-01-02").count() == 8
    assert partitions.read_stage(spark, base, "2024-01-01", "2024-01-02", include_hi=False).count() == 5
    assert partitions.read_stage(spark, base, "2024-01-02").columns == ["id"]
    assert len(list((tmp_path / "stage" / "p_date=2024-01-01").glob("*.parquet"))) >= 3


def test_registered(spark, tmp_path):
    base = f"{tmp_path}/open/registered_open/customer"
    def rows(email):
        return spark.createDataFrame([(email, "r", "A")], "email string, rowid string, c_operationtype string")
    write(rows("a"), base, "ods", "2023-07-31", "orc")
    write(rows("b"), base, "ods", "2021-01-01", "orc")
    write(rows("c"), base.replace("registered_open", "registered_nonopen"), "nds", "2020-01-01", "orc")
    write(rows("d"), base.replace("registered_open", "registered_storage"), "vds", "2023-07-01", "orc")
    df = partitions.load_registered(spark, base, "2021-01-01", "2023-07-31", False)
    assert df.columns == ["email"] and sorted(r[0] for r in df.collect()) == ["a", "b", "c"]
    df = partitions.load_registered(spark, base, "2023-07-01", "2023-07-31", True, stored_fmt="orc")
    assert [r[0] for r in df.collect()] == ["d"]


def stage_config(tmp_path):
    """The travel config plus the columns only the serving stage reads."""
    config = copy.deepcopy(travel.CONFIG)
    base = f"{tmp_path}/source_open"
    config["entityDetails"] = [
        {"entityName": n, "entityType": "snapshot", "pathUrl": f"{base}/{n}", "dataFormat": "parquet"}
        for n in travel.ENTITY_SQL]
    config["storageDetails"] = [{"pathUrl": f"{tmp_path}/out/{n}"} for n in
                                ("profiles", "clusters", "unified", "serving", "quarantine", "index")]
    for name in ("MiddleName", "HonorificPrefix", "HonorificSuffix", "EmailAddress", "Gender",
                 "DateOfBirth", "Zipcode", "Nationality", "City", "State"):
        source = ("all_passengeraddress", "City") if name != "DateOfBirth" else \
            ("all_passengerjourneysegment", "DepartureDate")
        config["attributeMapping"].append(travel._rule(name, "GetBookerDetails", source))
        config["profileSchema"].append({"columnName": name, "dataType": "string", "defaultValue": "Unknown"})
    config["storageDetails"].append({"pathUrl": f"{tmp_path}/out/changes"})
    config["reportPath"] = f"{tmp_path}/out/report"
    return config


def test_changes_are_captured_and_repeatable(spark, tmp_path):
    """The 'A' rows, by entity and date; a second run leaves the same rows in the same place."""
    config = stage_config(tmp_path)
    some = config["entityDetails"][:2]
    config["entityDetails"] = some
    need = {e["entityName"]: None for e in some}
    for e in some:
        df = travel.derive_all(spark, SF, {"e": travel.ENTITY_SQL[e["entityName"]]})["e"].limit(50)
        stored = e["pathUrl"].replace("source_open", "source_storage")
        op = F.when(F.monotonically_increasing_id() % 5 == 0, "A").otherwise("D") if e is some[0] else F.lit("D")
        write(df.withColumn("c_operationtype", op), stored, "vds", "2024-02-01")
        need[e["entityName"]] = df.columns
    stages = Stages(spark, config, stored_fmt="parquet")
    first = stages.capture_changes("2024-02-01", "2024-02-01")
    assert set(first) == set(need)
    rows = {n: sorted(map(str, spark.read.parquet(p).collect())) for n, p in first.items()}
    source = spark.read.parquet(some[0]["pathUrl"].replace("source_open", "source_storage")).filter("c_operationtype = 'A'")
    columns = spark.read.parquet(first[some[0]["entityName"]]).columns
    assert rows[some[0]["entityName"]] == sorted(map(str, source.select(*columns).collect())) and source.count() == 10
    assert rows[some[1]["entityName"]] == []
    again = stages.capture_changes("2024-02-01", "2024-02-01")
    assert again == first and {n: sorted(map(str, spark.read.parquet(p).collect())) for n, p in again.items()} == rows
    assert first[some[0]["entityName"]].endswith(f"changes/{some[0]['entityName']}/p_date=2024-02-01")


def test_counts_are_observed_by_the_write(spark, tmp_path):
    config = stage_config(tmp_path)
    stages = Stages(spark, config)
    df = spark.range(100).withColumn("id", F.when(F.col("id") % 10 > 0, F.col("id")))
    # partition columns aside, the plan that writes is the plan that counts
    path = stages.write(1, "sample", df, "2024-01-01", n_null=F.count_if(F.col("id").isNull()))
    assert path.endswith("p_date=2024-01-01") and stages.counts["sample"] == {"n_rows": 100, "n_null": 10}
    stored = spark.read.parquet(f"{config['reportPath']}/counts/sample/2024-01-01").first()
    assert (stored.n_rows, stored.n_null) == (100, 10)
    assert stages.write(1, "sample", df.limit(0), "2024-01-02") and stages.counts["sample"] == {"n_rows": 0}


def test_bucketed_index_is_joined_in_place(spark):
    """Only today's rows move: no exchange between the index table and the join."""
    schema = "pFirstName string, pLastName string, DateOfBirth string, passenger_hash string"
    spark.sql("DROP TABLE IF EXISTS identity_index_test")
    rows = lambda tag, n: spark.createDataFrame([(f"F{i % 7}", f"L{i}", " 1980-01-01", f"{tag}{i}") for i in range(n)], schema)
    sinks.write_index(rows("a", 40), "identity_index_test", "2024-01-01", 4)
    sinks.write_index(rows("b", 60), "identity_index_test", "2024-01-02", 4)
    sinks.write_index(rows("c", 50), "identity_index_test", "2024-01-02", 4)     # a repeated date is replaced
    sinks.write_index(rows("d", 9), "identity_index_test", "2024-01-03", 4)
    old = sinks.read_index(spark, "identity_index_test", "2024-01-03")
    assert old.count() == 90 and set(old.columns) == {"pFirstName", "pLastName", "DateOfBirth", "passenger_hash", "_dob"}
    profiles = spark.createDataFrame([(str(i), str(i), "Maria", f"Santos{i}", "1980-01-01", f"n{i}") for i in range(30)],
                                     "ProvisionalPrimaryKey string, PassengerID string, FirstName string, LastName string, "
                                     "DateOfBirth string, passenger_hash string")
    from kinfold.operators import identity
    index = identity.identity_index(profiles).withColumn("passenger_hash", F.concat(F.lit("old_"), "passenger_hash"))
    sinks.write_index(index, "identity_index_test", "2024-01-04", 4)
    old = sinks.read_index(spark, "identity_index_test", "2024-01-05")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        renewed, fresh = identity.carry_over(profiles, old)
        seen = identity.index_rows(profiles).withColumn("_dob", F.trim("DateOfBirth")).select(*sinks.INDEX_BLOCK, "passenger_hash")
        reduced = old.groupBy(*sinks.INDEX_BLOCK).agg(F.max("passenger_hash").alias("_old"))
        plan = seen.join(reduced, sinks.INDEX_BLOCK)._jdf.queryExecution().executedPlan().toString()
        moves = [line[:60] for line in plan.split("\n") if "Exchange" in line or "identity_index_test" in line]
        # one exchange, of today's rows; none between the table's buckets and the join
        assert len(moves) == 2 and "Exchange" in moves[0] and "FileScan" in moves[1], moves
        plain = identity.carry_over(profiles, old.drop("_dob"))
        got = sorted(map(str, renewed.select("ProvisionalPrimaryKey", "passenger_hash").collect()))
        assert got == sorted(map(str, plain[0].select("ProvisionalPrimaryKey", "passenger_hash").collect()))
        assert all("old_" in g for g in got) and fresh.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE identity_index_test")


def test_four_stages(spark, tmp_path):
    config = stage_config(tmp_path)
    for e in config["entityDetails"]:
        df = travel.derive_all(spark, SF, {"e": travel.ENTITY_SQL[e["entityName"]]})["e"]
        write(df, e["pathUrl"], "ods", "2024-01-31")
        stored = e["pathUrl"].replace("source_open", "source_storage")
        write(df.withColumn("c_operationtype", F.lit("D")), stored, "vds", "2024-02-01")
    stages = Stages(spark, config, stored_fmt="parquet")
    as_of = F.lit("2001-01-01").cast("date")

    stages.compute_profile("2021-01-01", "2024-01-31", as_of=as_of)
    profiles = spark.read.parquet(stages.path(0))
    assert profiles.count() == profiles.select("PassengerID").distinct().count() > 1000
    stages.compute_dedupe("2024-01-31")
    stages.compute_ucp("2021-01-01", "2024-01-31")
    first = partitions.read_stage(spark, stages.path(2), "2024-01-31")
    assert first.filter("passenger_hash IS NULL").count() == 0
    index = partitions.read_stage(spark, stages.path(5), "2024-01-31")
    assert index.count() > 0

    # The same people come again in an incremental run: nobody with a key is new.
    stages.compute_profile("2024-02-01", "2024-02-01", incremental=True, as_of=as_of)
    stages.compute_dedupe("2024-02-01")
    stages.compute_ucp("2021-01-01", "2024-02-01", incremental=True)
    second = partitions.read_stage(spark, stages.path(2), "2024-02-01")
    assert second.count() == first.count()
    fresh = spark.read.parquet(stages.path(5)).filter("p_date = '2024-02-01'")
    keyless = second.filter("ProvisionalPrimaryKey IS NULL").count()
    assert fresh.count() <= keyless <= 1

    written = stages.compute_ui("2021-01-01", "2024-02-01", as_of)
    passengers = spark.read.parquet(written["passenger_details"])
    assert passengers.select("passenger_hash").distinct().count() == passengers.count() > 0
    assert spark.read.parquet(written["index_milestone"]).first()["journeys"] == first.count()
    assert spark.read.parquet(written["booker_details"]).count() > 0
    assert spark.read.parquet(written["revenue_breakdown"]).count() == 3


def test_the_star_runs_once(spark):
    """No entity is scanned for heavy keys of the wide rows: the plan reads the big tables
    no more often than the entities derived from them need."""
    frames = travel.entities(spark, SF)
    tables = travel.profile.fold_entities(travel.profile.derive_tables(travel.apply_predicates(frames)),
                                          needed=travel.required_columns(travel.CONFIG))
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("parquet")
    star = scans(travel.profile.join_entities(tables))
    built = travel.profile.build_profiles(frames, travel.CONFIG, as_of=F.lit("2001-01-01").cast("date"))
    assert scans(built) <= star + 8      # vouchers, exclusion and heavy bookings read base tables


def test_merged_dimensions_equal_a_star(spark):
    from kinfold.operators import joins
    base = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, 2, 3, None, None, 9])], "i int, k int")
    a = spark.createDataFrame([(1, "a1"), (1, "a1b"), (2, "a2"), (None, "an")], "ka int, a string")
    b = spark.createDataFrame([(2, "b2"), (3, "b3"), (7, "b7")], "kb int, b string")
    c = spark.createDataFrame([(None, "cn"), (1, "c1")], "kc int, c string")
    star = joins.star_join(base, [(a, "k", "ka"), (b, "k", "kb"), (c, "k", "kc")])
    heavy = joins.null_key(a, "ka", "k").unionByName(
        spark.createDataFrame([(1, 250_000), (1, 5)], "k int, n_rows long"))
    looked = joins.salted_join(base, joins.merge_dimensions([(a, "ka"), (b, "kb"), (c, "kc")], "key"), "k", "key",
                               "left", null_safe=True, heavy=heavy).drop("key")
    assert sorted(map(str, looked.collect())) == sorted(map(str, star.collect()))


def test_serving_in_parts_and_by_day(spark, tmp_path):
    rows = travel.serving_rows(spark, SF).persist()
    tables = serving.tables_of(rows, newest=None, per_part=3, daily=True)
    wanted = ("index_milestone", "booker_details", "booker_timeline", "booker_histograms", "daily_milestones")
    written = sinks.write_serving({name: tables[name] for name in wanted}, str(tmp_path))
    read = {name: spark.read.parquet(path) for name, path in written.items()}

    def whole(df, *keys):
        texts = {}
        for r in df.orderBy("part").collect():
            texts.setdefault(tuple(r[k] for k in keys), []).append(r[-1])
        return {k: "".join(v) for k, v in texts.items()}

    details = read["booker_details"].collect()
    timeline = whole(read["booker_timeline"], "PersonID")
    known = {(r["PersonID"],): r["Details"] for r in details if r["PersonID"] is not None}
    assert known and {k: v for k, v in timeline.items() if k != (None,)} == known
    histograms = whole(read["booker_histograms"], "PersonID", "column")
    assert histograms and all(histograms.get((r["PersonID"], c), "{}") == r[c]
                              for r in details if r["PersonID"] is not None for c in serving.TRAVELLED)
    exact = read["index_milestone"].first()
    near = serve.milestones_of(read["daily_milestones"], list(serving.MILESTONES)).first()
    assert all(abs(near[n] - exact[n]) <= 0.04 * exact[n] + 1 for n in serving.MILESTONES)
    rows.unpersist()


@pytest.mark.parametrize("nulls", [True, False])
def test_widened_parents_equal_a_star(spark, nulls):
    """Rows without a parent, or whose parent has no key, meet the dimensions' null keys."""
    from kinfold.operators import joins
    from kinfold.session import stored
    rows = [(1, 10), (1, 11), (2, 10), (3, None), (None, 12)]
    base = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, 2, 3, 4, None])], "i int, k int")
    parent = spark.createDataFrame(rows, "p int, j int")
    a = spark.createDataFrame([(10, "a"), (10, "aa"), (11, "b")] + [(None, "an"), (None, "ann")] * nulls, "ja int, a string")
    b = spark.createDataFrame([(12, "x"), (10, "y")] + [(None, "bn")] * nulls, "jb int, b string")
    star = joins.star_join(base, [(parent, "k", "p"), (a, "j", "ja"), (b, "j", "jb")])
    widened = stored(joins.widen(parent, [(a, "j", "ja"), (b, "j", "jb")]))
    got = joins.look_up_widened(base, widened, lambda x, y: joins.star_join(x, [(y, "k", "p")]), parent.columns)
    assert got.columns == star.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, star.collect()))


def test_profiles_leave_few_shuffle_files(spark):
    """Of the joins that make the profiles stored tables are left, not their shuffle files."""
    as_of = F.lit("2001-01-01").cast("date")
    built = lambda: travel.profile.build_profiles(travel.entities(spark, SF), travel.CONFIG, as_of=as_of)
    assert leaves(spark, built) <= 12
    assert leaves(spark, lambda: travel.revenue_breakdown(spark, SF)) <= 6


def test_settling_by_row_equals_settling_whole_rows(spark):
    """One of a passenger's records stays, a registered address may repeat, flags come along."""
    golden = spark.createDataFrame(
        [("7_1", 7, 70, "A@x", "Yes", "f"), ("7_2", 7, 71, "b@x", "No", "g"), ("8_1", 8, 72, "a@x", "Yes", None),
         (None, 9, 73, "a@x", "No", "h"), ("9_5", None, 74, None, "No", "i"), ("10_1", 10, 75, "c@x", "Yes", "j")],
        "ProvisionalPrimaryKey string, PassengerID long, BookingID long, BookerEmailAddress string, "
        "IsRegistered string, FirstName string")
    registered = spark.createDataFrame([("a@X", 2.0), ("A@x", 1.0), ("b@x", 5.0)], "email string, balance double")
    frames = {
        "all_booking": spark.createDataFrame(
            [(b, f"L{b}", 2, datetime.datetime(2020, 1, 1)) for b in range(70, 76)],
            "BookingID long, RecordLocator string, Status int, BookingUTC timestamp"),
        "all_bookingpassenger": spark.createDataFrame([(70, 7)], "BookingID long, PassengerID long"),
        "all_payment": spark.createDataFrame([(72, "VO", 4, "1")],
                                             "BookingID long, PaymentMethodCode string, AuthorizationStatus int, AccountNumber string"),
        "all_voucher": spark.createDataFrame([("1", "L75", 5.0, 1.0, travel.fixed.VOUCHER_BASIS_CODES[0], 1)],
                                             "VoucherReference string, RecordLocator string, Amount double, Available double, "
                                             "voucherbasiscode string, status int")}
    whole = travel.profile.settle(golden, frames, registered)
    got = travel.profile.settle_by_row(golden, frames, registered)
    assert got.columns == whole.columns and got.count() == 4
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
