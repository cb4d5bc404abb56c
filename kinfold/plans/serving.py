"""Serving tables: milestones, revenue, passengers and bookers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import dates
from ..operators import serve
from ..operators.shape import dedup_by_key

PASSENGER_TEXT = [
    "FirstName", "MiddleName", "LastName", "HonorificPrefix", "HonorificSuffix",
    "EmailAddress", "Phone", "Gender", "ProvisionalPrimaryKey", "DateOfBirth", "Zipcode",
    "Nationality", "City", "State",
]
BOOKER_TEXT = ["BookerFirstName", "BookerLastName", "BookerEmailAddress", "BookerMobile",
               "BookerType", "BookerCity"]
TRAVELLED = ["TravelOrigin", "TravelDestination", "TravelSeat"]


def serving_rows(profiles: DataFrame, as_of: Column | None = None,
                 rates=fixed.CURRENCY_RATES) -> DataFrame:
    """One row per passenger with converted revenue, age band and booking month."""
    rows = dedup_by_key(profiles, "PassengerID", ["ProvisionalPrimaryKey"])
    rows = serve.normalise_currency(rows, "Revenue", "BookingCurrency", "New_Revenue", rates)
    rows = rows.withColumn("Age", dates.age(F.col("DateOfBirth"), as_of))
    return rows.withColumns({"AgeRange": dates.age_band(F.col("Age")),
                             "BookingMonth": dates.month_name(F.col("BookingDate"))})


MILESTONES = {"customers": "passenger_hash", "journeys": "PassengerID", "bookers": "PersonID",
              "bookings": "BookingID"}


def index_milestone(rows: DataFrame) -> DataFrame:
    return serve.milestones(rows, MILESTONES)


def daily_milestones(rows: DataFrame) -> DataFrame:
    """Mergeable sketches of the milestones per booking date; see `serve.milestones_of`."""
    return serve.milestone_sketches(rows, "BookingDate", MILESTONES)


def revenue_breakdown(rows: DataFrame) -> DataFrame:
    return serve.revenue_by_currency(rows, "BookingID", "New_Revenue", "BookingCurrency")


def _fields(revenue: str) -> dict[str, Column]:
    return {
        "origin": F.col("TravelOrigin"), "destination": F.col("TravelDestination"),
        "insurance": F.col("TravelInsurance"), "baggage": F.col("TravelBaggage"),
        "meals": F.col("TravelMeals"), "travel_date": dates.date_part(F.col("TravelDate")),
        "booking_date": dates.date_part(F.col("BookingDate")), "revenue": F.col(revenue),
        "record_locator": F.col("RecordLocator"), "IsCsp": F.col("IsCsp"),
    }


def _booker_fields() -> dict[str, Column]:
    return _fields("New_Revenue") | {"currency": F.col("BookingCurrency")}


def passenger_details(rows: DataFrame, vocab: dict | None = None, *, limit: int = serve.PIVOT_VALUES,
                      values: int | None = fixed.HISTOGRAM_VALUES,
                      newest: int | None = fixed.TIMELINE_ROWS) -> DataFrame:
    """`vocab` gives the pivot's values ready; else they are read, at most `limit` a column.
    `values` and `newest` are the lengths of histograms and timelines, None for all."""
    vocab = vocab or serve.vocabulary(rows, fixed.PASSENGER_INDICATORS, limit)
    stats = serve.entity_summary(
        rows, "passenger_hash", largest=PASSENGER_TEXT, date="BookingDate",
        counted="PassengerID", amount="New_Revenue", count_name="TotalBookings",
        amount_name="TotalRevenue", vocab=vocab)
    travelled = serve.histogram_json(rows, "passenger_hash", TRAVELLED, values)
    timeline = serve.timeline_json(rows, "passenger_hash", _fields("Revenue"), "TravelDate",
                                   ["PassengerID"], newest)
    out = serve.combine(stats, [(travelled, "left"), (timeline, "inner")], "passenger_hash")
    return out.fillna("{}", subset=TRAVELLED)


def booker_details(rows: DataFrame, vocab: dict | None = None, *, limit: int = serve.PIVOT_VALUES,
                   values: int | None = None, newest: int | None = fixed.TIMELINE_ROWS) -> DataFrame:
    """Like `passenger_details`.  With `values` None a booker's whole histogram is one text;
    `booker_values` gives it as rows, which no booker is too large for."""
    vocab = vocab or serve.vocabulary(rows, fixed.BOOKER_INDICATORS, limit)
    stats = serve.entity_summary(
        rows, "PersonID", largest=BOOKER_TEXT, date="BookingDate", counted="PassengerID",
        amount="New_Revenue", count_name="TotalPassengers", amount_name="TotalRevenue",
        vocab=vocab)
    clients = serve.distinct_counterparts(rows, "PersonID", "passenger_hash", "UniqueClients")
    travelled = serve.histogram_json(rows, "PersonID", TRAVELLED, values, fixed.UNKNOWN)
    timeline = serve.timeline_json(rows, "PersonID", _booker_fields(), "TravelDate", ["PassengerID"], newest)
    return serve.combine(stats, [(travelled, "left"), (clients, "left"), (timeline, "inner")],
                         "PersonID")


def booker_values(rows: DataFrame) -> DataFrame:
    """(PersonID, column, value, n): histograms and indicators as long rows."""
    return serve.value_counts(rows, "PersonID", [*TRAVELLED, *fixed.BOOKER_INDICATORS], fixed.UNKNOWN)


def booker_parts(rows: DataFrame, per_part: int = serve.PART_ROWS) -> dict[str, DataFrame]:
    """Whole timelines and histograms of bookers of any size, in parts to be joined in order."""
    return {"booker_timeline": serve.timeline_parts(rows, "PersonID", _booker_fields(), "TravelDate",
                                                    ["PassengerID"], per_part=per_part),
            "booker_histograms": serve.histogram_parts(rows, "PersonID", TRAVELLED, fixed.UNKNOWN, per_part)}


def serving_tables(profiles: DataFrame, as_of: Column | None = None,
                   rates=fixed.CURRENCY_RATES, **options) -> dict[str, DataFrame]:
    return tables_of(serving_rows(profiles, as_of, rates), **options)


def tables_of(rows: DataFrame, *, limit: int = serve.PIVOT_VALUES, long_rows: bool = False,
              passenger_values: int | None = fixed.HISTOGRAM_VALUES, booker_histogram: int | None = None,
              newest: int | None = fixed.TIMELINE_ROWS, per_part: int | None = None,
              daily: bool = False) -> dict[str, DataFrame]:
    """The serving tables by name.  On request also: booker values as long rows, whole booker
    texts in parts of `per_part` entries, daily sketches of the milestones."""
    out = {"index_milestone": index_milestone(rows),
           "revenue_breakdown": revenue_breakdown(rows),
           "passenger_details": passenger_details(rows, limit=limit, values=passenger_values, newest=newest),
           "booker_details": booker_details(rows, limit=limit, values=booker_histogram, newest=newest)}
    if long_rows:
        out["booker_values"] = booker_values(rows)
    if per_part:
        out |= booker_parts(rows, per_part)
    if daily:
        out["daily_milestones"] = daily_milestones(rows)
    return out
