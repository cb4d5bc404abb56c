"""Identity assignment, the identity index, carry-over and quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import text
from ..functions.scripts import with_readings
from ..session import discard, stored
from .joins import attach_hashed, heavy_keys, join_hashed
from .resolve import PersonSpec, add_keys, has_name, once, reject_placeholders

ID = "passenger_hash"
CROWD = 1000             # people whose ids are counted before everybody's


def assign_identity(profiles: DataFrame, clusters: DataFrame,
                    spec: PersonSpec = PersonSpec()) -> DataFrame:
    """Every profile row gets an identity.

    A row's cluster id spreads to all rows with the same case-folded name and
    birth date (the largest wins); a person without any cluster id gets a
    repeatable fallback from name and birth date.  The maximum is an aggregate
    attached back by a salted join, so a name shared by a third of all rows
    never lands in one task.  The names to salt are told by their cluster rows,
    which are counted with the maximum; no further pass over all rows counts names,
    and names with few such rows are left to adaptive execution.  Rows are dealt
    and sorted by hashes of keys and people, and compared where these agree.  The
    people with an id are stored, so that the shuffle files that found them go.
    """
    def folded(c: str) -> Column:
        return F.coalesce(F.lower(c), F.lit(fixed.UNKNOWN))

    rows = profiles.drop(ID)
    person = {"_f": folded(spec.first), "_l": folded(spec.last),
              "_d": F.coalesce(F.col(spec.dob).cast("string"), F.lit(fixed.NULL_TOKEN))}
    ids = clusters.select(F.col("provisionalprimarykey").alias(spec.key), ID)
    met = stored(join_hashed(rows.select(spec.key, *[c.alias(name) for name, c in person.items()]), ids, spec.key).drop(spec.key))
    counted = stored(met.groupBy(F.xxhash64(*person).alias("_person"), *person)
                     .agg(F.max(ID).alias("_known"), F.count("*").alias("n_rows")).filter(F.col("_known").isNotNull()))
    discard(met)
    out = attach_hashed(rows, counted.select(*person, "_known"), person, counted)
    fallback = F.md5(F.concat_ws("_", *person.values()))
    return out.withColumn(ID, F.coalesce("_known", fallback)).drop("_known")


def index_rows(profiles: DataFrame, spec: PersonSpec = PersonSpec()) -> DataFrame:
    """Eligible rows in index form: key, pFirstName, pLastName, DateOfBirth, id.

    Rows with an empty name or key stay out; they would match every other such row.
    """
    dob = F.col(spec.dob).cast("string")
    known = profiles.filter(F.col(spec.first).isNotNull() & F.col(spec.last).isNotNull()
                            & dob.isNotNull() & ~dob.like(fixed.MASKED_DOB))
    if spec.readings is not None:
        known = with_readings(known, [spec.first, spec.last], spec.readings)
    rows = once(
        known, [F.col(spec.key).alias("ProvisionalPrimaryKey"), dob.alias("DateOfBirth"), ID],
        first=text.normalise_name(text.transliterate(F.col(spec.first)), True),
        last=text.normalise_name(text.transliterate(F.col(spec.last)), True))
    rows = reject_placeholders(
        rows, F.col("first"), F.col("last"),
        [*spec.first_placeholders, *fixed.INDEX_EXTRA_PLACEHOLDERS],
        [*spec.last_placeholders, *fixed.INDEX_EXTRA_PLACEHOLDERS])
    rows = rows.filter(has_name("first", "last"))
    rows = add_keys(rows, "first", "last", "DateOfBirth", True, "pFirstName", "pLastName")
    return (rows.select("ProvisionalPrimaryKey", "pFirstName", "pLastName", "DateOfBirth", ID)
            .filter(has_name("pFirstName", "pLastName")))


def identity_index(profiles: DataFrame, spec: PersonSpec = PersonSpec()) -> DataFrame:
    """Different index rows.  The name rules, the dear part, run once per different person and id."""
    people = profiles.select(spec.first, spec.last, spec.dob, ID).distinct()
    keyless = people.withColumn(spec.key, F.lit(None).cast("string"))
    return index_rows(keyless, spec).drop("ProvisionalPrimaryKey").distinct()


def carry_over(profiles: DataFrame, old_index: DataFrame,
               spec: PersonSpec = PersonSpec()) -> tuple[DataFrame, DataFrame]:
    """Old identities win over new ones; returns (profiles, new index rows).

    The old index is reduced to its largest id per (names, birth date) before
    the join, so a block with many old ids meets many new rows only once each.
    `profiles` is read several times: hand in a stored table.
    An index with a column _dob (the trimmed birth date, see `sinks.write_index`) is
    grouped and joined where its buckets lie; only today's rows are shuffled.
    """
    observed = stored(index_rows(profiles, spec).withColumn("_dob", F.trim("DateOfBirth")))
    block = ["pFirstName", "pLastName", "_dob"]
    bucketed = "_dob" in old_index.columns
    if not bucketed:
        old_index = old_index.withColumn("_dob", F.trim(F.col("DateOfBirth").cast("string")))
    old = (old_index.filter(has_name("pFirstName", "pLastName"))
           .groupBy(*block).agg(F.max(ID).alias("_old")))
    old = old if bucketed else stored(old)
    seen = observed.select(*block, ID).distinct().join(old, block)
    overrides = stored(seen.groupBy(ID).agg(F.max("_old").alias("_old")))
    renewed = attach_hashed(profiles, overrides, [ID])
    renewed = renewed.withColumn(ID, F.coalesce("_old", ID)).drop("_old")
    retained = (observed.join(old, block, "left_semi")
                .select("ProvisionalPrimaryKey").distinct())
    fresh = (observed.join(retained, "ProvisionalPrimaryKey", "left_anti")
             .select("pFirstName", "pLastName", "DateOfBirth", ID).distinct())
    return renewed, fresh


def identities_per_person(profiles: DataFrame, spec: PersonSpec = PersonSpec()) -> DataFrame:
    return (profiles.groupBy(spec.first, spec.last, spec.dob)
            .agg(F.count("*").alias("n_rows"), F.countDistinct(ID).alias("n_ids"),
                 F.sum(F.col(ID).isNull().cast("long")).alias("n_without_id")))


def quality_metrics(profiles: DataFrame, spec: PersonSpec = PersonSpec()) -> DataFrame:
    """One row: rows, distinct people, distinct ids, rows without id, ambiguous people.

    Whether a person has several ids is told by the smallest and the largest, in the one
    shuffle that counts the rows; counting them would shuffle every (person, id) before.
    """
    people = (profiles.groupBy(spec.first, spec.last, spec.dob)
              .agg(F.count("*").alias("n_rows"), F.min(ID).alias("_low"), F.max(ID).alias("_high"),
                   F.count(F.when(F.col(ID).isNull(), 1)).alias("n_without_id"))).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_people"),
        F.coalesce(F.sum("n_without_id"), F.lit(0)).alias("n_without_id"),
        F.count(F.when(F.col("_low") != F.col("_high"), 1)).alias("n_ambiguous"))
    ids = profiles.agg(F.countDistinct(ID).alias("n_ids"))
    # Two one-row results side by side, as a union rather than a product.
    names = ["n_rows", "n_people", "n_without_id", "n_ambiguous", "n_ids"]
    both = people.unionByName(ids, allowMissingColumns=True)
    return both.agg(*[F.max(n).cast("bigint").alias(n) for n in names])


def ambiguous_people(profiles: DataFrame, spec: PersonSpec = PersonSpec(),
                     top: int = 10) -> DataFrame:
    """The people with the most different ids (a top-k report).

    Nobody has more ids than rows.  Rows are counted first, one short row per person in the
    shuffle, and ids for the people with the most rows only.  If the last of the answer has no
    more ids than someone left out has rows, ids are counted for everybody.
    """
    def most(rows: DataFrame) -> DataFrame:
        return (identities_per_person(rows, spec).filter("n_ids > 1")
                .orderBy(F.desc("n_ids"), spec.first, spec.last, spec.dob).limit(top))

    person = [spec.first, spec.last, spec.dob]
    crowd = max(CROWD, top)
    counted = heavy_keys(profiles, person, crowd).collect()     # at most `crowd` rows
    if not counted:
        return most(profiles)
    spark = profiles.sparkSession
    listed = spark.createDataFrame(counted, profiles.select(*person, F.lit(1).cast("bigint").alias("n_rows")).schema)
    named = F.broadcast(listed.select(*[F.col(c).alias(f"_{c}") for c in person]))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in person]
    found = most(profiles.join(named, same, "left_semi"))
    rows = found.collect()                                      # at most `top` rows
    if len(counted) < crowd or (len(rows) == top and rows[-1]["n_ids"] > counted[-1]["n_rows"]):
        return spark.createDataFrame(rows, found.schema)
    return most(profiles)
