"""Profile building: entity tables to one golden row per provisional key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.attributes import map_attributes
from ..functions.dates import local_date, until_yesterday
from ..functions.text import digits_only, email_key
from ..operators import joins, shape
from ..session import discard, stored

Frames = Mapping[str, DataFrame]


def derive_tables(frames: Frames) -> dict[str, DataFrame]:
    """Paths, latest passports, named fees, first segment and party size."""
    out = dict(frames)
    segments = frames["all_passengerjourneysegment"]
    out["all_passengerjourneyleg"] = shape.ordered_path(
        frames["all_passengerjourneyleg"], "PassengerID", ["SegmentID", "LegNumber"],
        "UnitDesignator")
    out["GetTravelDestination_all_passengerjourneysegment"] = shape.ordered_path(
        segments, "PassengerID", ["JourneyNumber", "SegmentNumber"], "ArrivalStation")
    out["GetPassportNumber_all_passengertraveldoc"] = shape.latest_document(
        frames["all_passengertraveldoc"], "PassengerID")
    out["GetPassportNumber_all_traveldoc"] = shape.latest_document(
        frames["all_traveldoc"], "PersonID")
    names = frames["all_fee"].select(F.col("FeeCode").alias("_code"), "Name")
    fees = frames["all_passengerfee"].select("PassengerID", "FeeCode")
    out["all_fee"] = fees.join(names, fees["FeeCode"] == names["_code"], "left").drop("_code")
    out["all_passengerjourneysegment"] = shape.first_in_group(
        segments, {"JourneyNumber": 1, "SegmentNumber": 1})
    out["GetTravelSoloOrGroup_all_bookingpassenger"] = shape.solo_or_group(
        frames["all_bookingpassenger"], "BookingID", "PassengerID")
    out.pop("all_passengerfee")
    return out


FOLDED = {
    "all_bookingcontact": ("BookingID", "TypeCode"),
    "all_passengertraveldoc": ("PassengerID", "DocTypeCode"),
    "all_fee": ("PassengerID", "FeeCode"),
    "all_traveldoc": ("PersonID", "DocTypeCode"),
    "all_personphone": ("PersonID", "TypeCode"),
}


def fold_entities(frames: Frames, folded: Mapping[str, tuple] = FOLDED,
                  needed: Mapping[str, list] | None = None) -> dict[str, DataFrame]:
    out = dict(frames)
    for name, (key, code) in folded.items():
        values = [c for c in (needed or {}).get(name, out[name].columns)
                  if c not in (key, code)]
        out[name] = shape.fold_code_values(out[name], key, code, values)
    return out


# Columns that the plan itself reads, whatever the attribute config maps: join keys, fold
# codes, sequence columns, predicates, voucher rules.  Entities come without others.
PLAN_COLUMNS = {
    "all_booking": ["BookingID", "CreatedUserID", "Status", "BookingUTC", "RecordLocator"],
    "all_agent": ["AgentID", "PersonID"],
    "all_person": ["PersonID"],
    "all_personname": ["PersonID", "NameType"],
    "all_personemail": ["PersonID", "IsDefault"],
    "all_personphone": ["PersonID", "IsDefault", "TypeCode"],
    "all_personaddress": ["PersonID", "IsDefault"],
    "all_traveldoc": ["PersonID", "DocTypeCode", "DocNumber", "IssuedByCode", "ExpirationDate"],
    "all_bookingpassenger": ["BookingID", "PassengerID"],
    "all_payment": ["BookingID", "PaymentMethodCode", "AuthorizationStatus", "AccountNumber"],
    "all_bookingcontact": ["BookingID", "TypeCode"],
    "all_passengeraddress": ["PassengerID"],
    "all_passengertraveldoc": ["PassengerID", "DocTypeCode", "DocNumber", "IssuedByCode", "ExpirationDate"],
    "all_passengerjourneysegment": ["PassengerID", "JourneyNumber", "SegmentNumber", "ArrivalStation"],
    "all_passengerjourneyleg": ["PassengerID", "SegmentID", "LegNumber", "UnitDesignator"],
    "all_passengerfee": ["PassengerID", "FeeCode"],
    "all_fee": ["FeeCode", "Name"],
    "all_voucher": ["VoucherReference", "RecordLocator", "Amount", "Available", "voucherbasiscode", "status"],
}
DERIVED_FROM = {
    "GetTravelDestination_all_passengerjourneysegment": "all_passengerjourneysegment",
    "GetPassportNumber_all_passengertraveldoc": "all_passengertraveldoc",
    "GetPassportNumber_all_traveldoc": "all_traveldoc",
    "GetTravelSoloOrGroup_all_bookingpassenger": "all_bookingpassenger",
}
MADE_HERE = {"all_fee": ["PassengerID"], "GetTravelSoloOrGroup_all_bookingpassenger": ["TravelSoloOrGroup"],
             "all_booking": ["Source"]}


def source_columns(config: Mapping) -> dict[str, list[str]]:
    """Columns to read from each stored entity: what the config maps and the plan uses."""
    out = {name: list(columns) for name, columns in PLAN_COLUMNS.items()}
    for name, columns in shape.required_columns(config).items():
        own = out.setdefault(DERIVED_FROM.get(name, name), [])
        own += [c for c in columns if c not in own and c not in MADE_HERE.get(name, ())]
    return out


BOOKING = "all_booking_BookingID"
PASSENGER = "all_bookingpassenger_PassengerID"
PASSENGER_ENTITY = "all_bookingpassenger"
PERSON = "all_person_PersonID"
# (entity, left key, right key); steps with one left key stand together so that
# the rows are exchanged once per key.
STAR = [
    ("all_bookingpassenger", BOOKING, "BookingID"),
    ("all_payment", BOOKING, "BookingID"),
    ("all_bookingcontact", BOOKING, "BookingID"),
    ("GetTravelSoloOrGroup_all_bookingpassenger", BOOKING, "BookingID"),
    ("all_person", "all_agent_PersonID", "PersonID"),
    ("all_personname", PERSON, "PersonID"),
    ("all_personemail", PERSON, "PersonID"),
    ("all_personphone", PERSON, "PersonID"),
    ("all_personaddress", PERSON, "PersonID"),
    ("all_traveldoc", PERSON, "PersonID"),
    ("GetPassportNumber_all_traveldoc", PERSON, "PersonID"),
    ("all_passengeraddress", PASSENGER, "PassengerID"),
    ("all_passengertraveldoc", PASSENGER, "PassengerID"),
    ("GetPassportNumber_all_passengertraveldoc", PASSENGER, "PassengerID"),
    ("all_passengerjourneysegment", PASSENGER, "PassengerID"),
    ("GetTravelDestination_all_passengerjourneysegment", PASSENGER, "PassengerID"),
    ("all_passengerjourneyleg", PASSENGER, "PassengerID"),
    ("all_fee", PASSENGER, "PassengerID"),
]


def join_entities(frames: Frames, star=STAR) -> DataFrame:
    """Bookings full outer agents, then the left-join star.

    What hangs on a person is joined to the agents first, and what hangs on a passenger to
    the booking's passengers: short rows move there, and each such table is stored, so that
    its shuffle files go.  The bookings then look up the agents in one salted join (an agent
    may have made a third of all bookings), and the passengers with the tables of a booking.
    """
    wide = {name: shape.prefix_columns(df, name) for name, df in frames.items()}
    bookings, agents, passengers = wide["all_booking"], wide["all_agent"], wide[PASSENGER_ENTITY]
    user, agent = "all_booking_CreatedUserID", "all_agent_AgentID"
    steps = [(wide[name], left, f"{name}_{right}") for name, left, right in star]

    persons = stored(joins.widen(agents, [s for s in steps if s[1] not in (BOOKING, PASSENGER)]))
    travellers = stored(joins.widen(passengers, [s for s in steps if s[1] == PASSENGER]))
    heavy = joins.heavy_keys(bookings, user, joins.SALTED_KEYS, joins.ROWS_PER_SALT)
    base = joins.look_up_widened(
        bookings, persons, lambda b, p: joins.full_outer(b, p, user, agent, heavy=heavy), agents.columns)
    base = joins.star_join(base, [s for s in steps if s[1] == BOOKING and s[0] is not passengers])
    key = f"{PASSENGER_ENTITY}_BookingID"
    return joins.look_up_widened(
        base, travellers, lambda b, p: joins.star_join(b, [(p, BOOKING, key)]), passengers.columns)


def collapse(mapped: DataFrame, config: Mapping, on_null_key: str = "merge") -> DataFrame:
    types = shape.declared_columns(config["profileSchema"])
    rows = mapped.select(*types)
    if "Phone" in rows.columns:
        rows = rows.withColumn("Phone", digits_only(F.col("Phone")))
    golden = shape.golden_record(shape.cast_to_schema(rows, types), "ProvisionalPrimaryKey",
                                 on_null_key)
    defaults = {c["columnName"]: c.get("defaultValue") for c in config["profileSchema"]}
    return shape.fill_defaults(golden, defaults)


def enrich_registered(profiles: DataFrame, registered: DataFrame,
                      prefix: str = "ciam") -> DataFrame:
    """Registered-customer columns for registered bookers, by lower-cased e-mail."""
    r = shape.prefix_columns(registered, prefix)
    r = r.withColumn(f"{prefix}_email", email_key(F.col(f"{prefix}_email")))
    p = profiles.withColumn("BookerEmailAddress", email_key(F.col("BookerEmailAddress")))
    return joins.conditional_left(p, r, p["BookerEmailAddress"] == r[f"{prefix}_email"],
                                  p["IsRegistered"] == "Yes")


def voucher_bookings(frames: Frames, as_of: Column | None = None) -> DataFrame:
    """Bookings paid, up to yesterday, with a partly used voucher of the right kind."""
    b = frames["all_booking"].filter(
        until_yesterday(F.col("BookingUTC"), as_of)
        & F.col("Status").isin(fixed.VOUCHER_BOOKING_STATUSES)).select("BookingID")
    p = frames["all_payment"].filter(
        (F.col("PaymentMethodCode") == fixed.VOUCHER_PAYMENT_METHOD)
        & (F.col("AuthorizationStatus") == fixed.VOUCHER_AUTHORIZATION_STATUS)
    ).select("BookingID", "AccountNumber")
    v = frames["all_voucher"].filter(
        (F.col("Amount") > F.col("Available"))
        & F.col("voucherbasiscode").isin(fixed.VOUCHER_BASIS_CODES)
        & (F.col("status") == fixed.VOUCHER_STATUS)).select("VoucherReference")
    paid = p.join(v, p["AccountNumber"] == v["VoucherReference"], "left_semi")
    return b.join(paid, "BookingID", "left_semi").distinct()


def flag_vouchers(profiles: DataFrame, frames: Frames, as_of: Column | None = None) -> DataFrame:
    """The heavy bookings are counted in the passenger table: counting them in the
    profiles would run the whole star a second time."""
    heavy = joins.heavy_keys(frames["all_bookingpassenger"].select("BookingID"), "BookingID",
                             joins.SALTED_KEYS, joins.ROWS_PER_SALT)
    return joins.flag_by_key(profiles, voucher_bookings(frames, as_of), "BookingID", "IsCsp",
                             heavy=heavy)


def exclude_voucher_records(profiles: DataFrame, frames: Frames) -> DataFrame:
    """Drop profiles whose booking shares its record locator with a voucher."""
    vouchers = frames["all_voucher"].select("RecordLocator")
    shared = (frames["all_booking"].select("BookingID", "RecordLocator")
              .join(vouchers, "RecordLocator", "left_semi"))
    return joins.exclude_by_key(profiles, shared, "BookingID")


def exclude_status(profiles: DataFrame, status: int = 4) -> DataFrame:
    """Optional second exclusion of older builds: cancelled bookings."""
    return profiles.filter(F.col("Status") != status)


def revenue_in_home_currency(profiles: DataFrame, history: DataFrame,
                             home: str = fixed.HOME_CURRENCY) -> DataFrame:
    """Optional step: booking revenue converted at the rate in force on the local day."""
    rates = history.withColumnRenamed("FromCurrencyCode", "BookingCurrency")
    rates = rates.withColumn("VersionStartUTC", F.col("VersionStartUTC").cast("timestamp"))
    dated = profiles.withColumn("_local_day", local_date(F.col("BookingDate")))
    out = joins.asof_rate_join(dated, rates, "BookingCurrency", "_local_day",
                               "VersionStartUTC", ["ConversionRate"])
    return joins.convert_revenue(out.drop("_local_day"), home)


def settle(profiles: DataFrame, frames: Frames, registered: DataFrame | None = None, as_of: Column | None = None,
           excluded_status: int | None = None) -> DataFrame:
    """Registered columns, voucher flag and exclusions, then one row per passenger."""
    if registered is not None:
        profiles = enrich_registered(profiles, registered)
    profiles = flag_vouchers(profiles, frames, as_of)
    profiles = exclude_voucher_records(profiles, frames)
    if excluded_status is not None:
        profiles = exclude_status(profiles, excluded_status)
    return shape.dedup_by_key(profiles, "PassengerID", ["ProvisionalPrimaryKey"])


def settle_by_row(golden: DataFrame, frames: Frames, registered: DataFrame | None = None, as_of: Column | None = None,
                  excluded_status: int | None = None) -> DataFrame:
    """`settle` on the columns it reads; the rows it keeps are looked up in the stored ones.

    So whole rows move once, not once per step.  Only for records whose ProvisionalPrimaryKey
    differs in every row: else whole rows decide which of two rows a passenger keeps.
    """
    golden = stored(golden.withColumn("_row", F.monotonically_increasing_id()))
    read = ["BookingID", "PassengerID", "ProvisionalPrimaryKey"]
    read += [] if registered is None else ["BookerEmailAddress", "IsRegistered"]
    read += [] if excluded_status is None else ["Status"]
    kept = settle(golden.select("_row", *read), frames, registered, as_of, excluded_status)
    new = [c for c in kept.columns if c not in golden.columns]
    if registered is not None:
        golden = golden.withColumn("BookerEmailAddress", email_key(F.col("BookerEmailAddress")))
    others = [c for c in golden.columns if c not in ("_row", "BookingID")]
    return golden.join(kept.select("_row", *new), "_row").select("BookingID", *others, *new)


def build_profiles(frames: Frames, config: Mapping, registered: DataFrame | None = None, *,
                   as_of: Column | None = None, on_null_key: str = "merge",
                   history: DataFrame | None = None, excluded_status: int | None = None) -> DataFrame:
    """The whole stage over already loaded entity tables.

    With a conversion `history` revenue is in the home currency; `excluded_status` drops
    profiles of that booking status.  Joined rows and golden records are stored, so that the
    shuffle files of one step are gone in the next.
    """
    raw = shape.apply_predicates(frames)
    tables = fold_entities(derive_tables(raw), needed=shape.required_columns(config))
    mapped = map_attributes(join_entities(tables), config["attributeMapping"],
                            config.get("columnMapping", ()))
    mapped = stored(mapped.select(*shape.declared_columns(config["profileSchema"])))
    golden = collapse(mapped, config, on_null_key)
    key_default = {c["columnName"]: c.get("defaultValue") for c in config["profileSchema"]}.get("ProvisionalPrimaryKey")
    one_per_key = on_null_key != "keep" and key_default is None
    profiles = (settle_by_row if one_per_key else settle)(golden, raw, registered, as_of, excluded_status)
    if one_per_key:
        discard(mapped)
    return profiles if history is None else revenue_in_home_currency(profiles, history)


def merge_master(passengers: DataFrame, prior_profiles: DataFrame, persons: DataFrame,
                 passenger_key: str = PASSENGER, prior_key: str = "PassengerID",
                 user_key: str = "all_booking_CreatedUserID",
                 agent_key: str = "all_agent_AgentID") -> DataFrame:
    """Booking master with prior profiles, then with persons: every non-null key of
    either side, as a salted full join."""
    known = passengers.join(prior_profiles,
                            passengers[passenger_key] == prior_profiles[prior_key], "left")
    return joins.salted_join(known, persons, user_key, agent_key, "full", drop_null_keys=True)
