"""The profile and serving stages over booking-system tables derived from the test tables.

Orders are bookings, order lines passengers with their documents, fees and
segments, customers agents and persons.  The derived tables are portable SQL, so
the check SQL starts from the very same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed
from ..functions.attributes import map_attributes
from ..operators.shape import apply_predicates, required_columns
from ..plans import profile, serving
from ..plans.people import unify_profiles
from ..session import stored
from .tables import derive_all, plain

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def keep(fn):
        QUERIES[name] = (fn, sql)
        return fn
    return keep


PASSENGER = "l_orderkey * 10 + l_linenumber"
TEXT = "VARCHAR(60)"

ENTITY_SQL = {
    "all_booking": """
      SELECT o_orderkey AS BookingID, o_custkey AS CreatedUserID,
        concat('L', cast(o_orderkey AS VARCHAR(60))) AS RecordLocator,
        CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 3 ELSE 4 END AS Status,
        cast(o_orderdate AS TIMESTAMP) AS BookingUTC, o_totalprice AS Revenue,
        CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
          WHEN '5-LOW' THEN 9 ELSE 4 END AS ChannelType,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'JPY' ELSE 'PHP' END
          AS CurrencyCode
      FROM {orders}""",
    "all_bookingpassenger": f"""
      SELECT DISTINCT l_orderkey AS BookingID, {PASSENGER} AS PassengerID FROM {{lineitem}}""",
    "all_bookingcontact": """
      SELECT l_orderkey AS BookingID, CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'N' THEN 'W' ELSE 'X' END
        AS TypeCode, concat('contact ', cast(l_partkey AS VARCHAR(60))) AS FirstName,
        concat('line ', cast(l_suppkey AS VARCHAR(60))) AS Address1, l_linestatus AS City
      FROM {lineitem}""",
    "all_passengeraddress": f"""
      SELECT {PASSENGER} AS PassengerID, max(concat('street ', cast(l_suppkey AS VARCHAR(60)))) AS Address1,
        max(nullif(l_linestatus, 'F')) AS City, max(l_returnflag) AS Country,
        max(concat('+63-', cast(l_partkey AS VARCHAR(60)))) AS Phone FROM {{lineitem}} GROUP BY 1""",
    "all_passengertraveldoc": f"""
      SELECT {PASSENGER} AS PassengerID,
        CASE l_suppkey % 6 WHEN 0 THEN 'P' WHEN 1 THEN 'OAFF' WHEN 2 THEN 'CEB' WHEN 3 THEN 'CEBD'
          WHEN 4 THEN 'S' END AS DocTypeCode,
        concat('D', cast(l_partkey AS VARCHAR(60))) AS DocNumber, l_linestatus AS IssuedByCode,
        cast(l_shipdate AS DATE) AS ExpirationDate FROM {{lineitem}}""",
    "all_passengerjourneysegment": f"""
      SELECT {PASSENGER} AS PassengerID, 1 + l_suppkey % 2 AS JourneyNumber,
        1 + l_partkey % 2 AS SegmentNumber,
        concat('S', cast(l_suppkey % 7 AS VARCHAR(60))) AS ArrivalStation,
        concat('O', cast(l_suppkey % 5 AS VARCHAR(60))) AS DepartureStation,
        cast(cast(l_shipdate AS DATE) AS VARCHAR(60)) AS DepartureDate FROM {{lineitem}}""",
    "all_passengerjourneyleg": f"""
      SELECT {PASSENGER} AS PassengerID, l_suppkey % 3 AS SegmentID, l_partkey % 3 AS LegNumber,
        concat(cast(l_quantity AS BIGINT), l_returnflag) AS UnitDesignator FROM {{lineitem}}""",
    "all_passengerfee": f"""
      SELECT {PASSENGER} AS PassengerID, CASE p_type WHEN 'ECONOMY' THEN 'BAG20' WHEN 'SMALL' THEN 'MEAL1'
          WHEN 'STANDARD' THEN 'INSRT' WHEN 'PROMO' THEN 'BAG35' END AS FeeCode
      FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "all_fee": """
      SELECT CASE p_type WHEN 'ECONOMY' THEN 'BAG20' WHEN 'SMALL' THEN 'MEAL1'
          WHEN 'STANDARD' THEN 'INSRT' WHEN 'PROMO' THEN 'BAG35' ELSE 'OTHER' END AS FeeCode,
        concat('fee ', lower(min(p_type))) AS Name FROM {part} GROUP BY 1""",
    "all_payment": """
      SELECT o_orderkey AS BookingID, CASE WHEN o_totalprice > 200000 THEN 'VO' ELSE 'CC' END
        AS PaymentMethodCode, cast(o_custkey AS VARCHAR(60)) AS AccountNumber,
        CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 4 END AS AuthorizationStatus FROM {orders}""",
    "all_voucher": """
      SELECT cast(c_custkey AS VARCHAR(60)) AS VoucherReference,
        concat('L', cast(c_custkey * 7 AS VARCHAR(60))) AS RecordLocator, c_acctbal AS Amount,
        1000.0 AS Available, CASE c_mktsegment WHEN 'MACHINERY' THEN '99PHP' WHEN 'FURNITURE'
          THEN '99CSP3' ELSE 'OTHER' END AS voucherbasiscode, 1 AS status FROM {customer}""",
    "all_agent": """
      SELECT c_custkey AS AgentID, 100000 + c_custkey AS PersonID FROM {customer}
      WHERE c_mktsegment <> 'HOUSEHOLD'""",
    "all_person": """
      SELECT 100000 + c_custkey AS PersonID, c_nationkey % 4 AS PersonType FROM {customer}""",
    "all_personname": """
      SELECT 100000 + c_custkey AS PersonID, 1 + c_nationkey % 2 AS NameType, c_mktsegment AS FirstName,
        c_name AS LastName FROM {customer}""",
    "all_personemail": """
      SELECT 100000 + c_custkey AS PersonID, c_nationkey < 20 AS IsDefault,
        concat(c_name, '@Example.com') AS EmailAddress FROM {customer}""",
    "all_personphone": """
      SELECT 100000 + c_custkey AS PersonID, c_nationkey < 22 AS IsDefault,
        CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'H' ELSE 'F' END AS TypeCode,
        cast(c_custkey * 31 AS VARCHAR(60)) AS PhoneNumber FROM {customer}""",
    "all_personaddress": """
      SELECT 100000 + c_custkey AS PersonID, true AS IsDefault, n_name AS Address1,
        c_mktsegment AS City, cast(n_regionkey AS VARCHAR(60)) AS Country
      FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "all_traveldoc": """
      SELECT 100000 + c_custkey AS PersonID, CASE c_nationkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'OAFF'
          WHEN 2 THEN 'GG' WHEN 3 THEN 'CEB' ELSE 'S' END AS DocTypeCode,
        concat('T', cast(c_custkey AS VARCHAR(60))) AS DocNumber, 'PH' AS IssuedByCode,
        DATE '2030-01-01' AS ExpirationDate FROM {customer}""",
}

REGISTERED_SQL = """SELECT upper(concat(c_name, '@example.com')) AS email, c_acctbal AS balance
  FROM {customer} WHERE c_acctbal > 0"""


def _rule(attribute, function, *sources):
    return {"attributeName": attribute, "transformationFunction": function,
            "sourceColumns": [{"entityName": e, "columnName": c} for e, c in sources]}


CONTACT, ADDRESS, DOC = "all_bookingcontact", "all_passengeraddress", "all_passengertraveldoc"
NAME, PDOC, PADDRESS = "all_personname", "all_traveldoc", "all_personaddress"
SEGMENT, PHONE = "all_passengerjourneysegment", "all_personphone"

RULES = [
    _rule("TravelSoloOrGroup", "GetTravelSoloOrGroup", ("all_bookingpassenger", "PassengerID")),
    _rule("PersonID", "GetPersonID", ("all_person", "PersonID")),
    _rule("ProvisionalPrimaryKey", "GetProvisionalPrimaryKey",
          ("all_bookingpassenger", "PassengerID"), ("all_person", "PersonID")),
    _rule("IsRegistered", "GetIsRegistered", (ADDRESS, "City"), (ADDRESS, "City"),
          (PADDRESS, "Country"), (PADDRESS, "Country")),
    _rule("FirstName", "GetDetails", (ADDRESS, "Address1"), (NAME, "FirstName")),
    _rule("LastName", "GetDetails", (ADDRESS, "Country"), (NAME, "LastName")),
    _rule("Phone", "GetDetailsPhone", (ADDRESS, "Phone"), (PHONE, "PhoneNumber")),
    _rule("PassportNumber", "GetPassportNumber", (DOC, "DocNumber"), (PDOC, "DocNumber")),
    _rule("StreetAddress", "GetStreetAddress", (ADDRESS, "Address1"), (ADDRESS, "City"),
          (ADDRESS, "Country"), (PADDRESS, "Address1"), (PADDRESS, "City"), (PADDRESS, "Country")),
    _rule("GoID", "GetGoIdFun", (DOC, "DocNumber"), (PDOC, "DocNumber")),
    _rule("SeniorCitizenID", "GetSeniorCitizenID", (DOC, "DocNumber"), (PDOC, "DocNumber")),
    _rule("BookedByAgentID", "GetBookedByAgentID", ("all_agent", "AgentID")),
    _rule("TravelSeat", "GetTravelSeat", ("all_passengerjourneyleg", "UnitDesignator")),
    _rule("TravelOrigin", "GetTravelOriginAndDate", (SEGMENT, "DepartureStation")),
    _rule("TravelDate", "GetTravelOriginAndDate", (SEGMENT, "DepartureDate")),
    _rule("TravelBaggage", "GetTravelBaggageMealsInsurance", ("all_fee", "Name")),
    _rule("TravelMeals", "GetTravelBaggageMealsInsurance", ("all_fee", "Name")),
    _rule("TravelInsurance", "GetTravelBaggageMealsInsurance", ("all_fee", "Name")),
    _rule("GoKeyedIn", "GetTravelGetGoKeyedIn", (DOC, "DocNumber")),
    _rule("IsPassenger", "GetIsPassenger", ("all_bookingpassenger", "PassengerID")),
    _rule("IsEmployee", "GetIsEmployee", (DOC, "DocNumber"), (PDOC, "DocNumber")),
    _rule("IsEmployeeDependent", "GetIsEmployeeDependent", (DOC, "DocNumber"), (PDOC, "DocNumber")),
    _rule("TravelDestination", "GetTravelDestination", (SEGMENT, "ArrivalStation")),
    _rule("BookerLastName", "GetBookerDetails", (NAME, "LastName")),
    _rule("BookerFirstName", "GetBookerDetails", (NAME, "FirstName")),
    _rule("BookerEmailAddress", "GetBookerDetails", ("all_personemail", "EmailAddress")),
    _rule("BookerCity", "GetBookerDetails", (PADDRESS, "City")),
    _rule("BookerPassportNumber", "GetBookerPassportNumber", (PDOC, "DocNumber")),
    _rule("BookerType", "GetBookerType", ("all_person", "PersonType")),
    _rule("BookerMobile", "GetBookerMobile", (PHONE, "PhoneNumber")),
    _rule("BookerHomePhone", "GetBookerHomePhone", (PHONE, "PhoneNumber")),
    _rule("BookerStreetAddress", "GetBookerStreetAddress", (PADDRESS, "Address1"),
          (PADDRESS, "City"), (PADDRESS, "Country")),
    _rule("BookerGoID", "GetBookerGetGoID", (PDOC, "DocNumber")),
    _rule("PrimaryContact", "GetPrimaryNames", (CONTACT, "FirstName")),
    _rule("AdditionalContact", "GetAdditionalNames", (CONTACT, "FirstName")),
    _rule("PrimaryContactAddress", "GetPrimaryContactStreetAddress", (CONTACT, "FirstName"),
          (CONTACT, "Address1"), (CONTACT, "City")),
    _rule("AdditionalContactAddress", "GetAdditionalContactStreetAddress", (CONTACT, "FirstName"),
          (CONTACT, "Address1"), (CONTACT, "City")),
    _rule("BookingChannel", "GetBookingChannel", ("all_booking", "ChannelType")),
    _rule("PaymentMethod", "GetPaymentMethodCode", ("all_payment", "PaymentMethodCode")),
    _rule("Ignored", "NoSuchRule", ("all_booking", "ChannelType")),
]
DIRECT = [("all_bookingpassenger", "PassengerID", "PassengerID"),
          ("all_booking", "BookingID", "BookingID"),
          ("all_booking", "RecordLocator", "RecordLocator"),
          ("all_booking", "BookingUTC", "BookingDate"), ("all_booking", "Revenue", "Revenue"),
          ("all_booking", "CurrencyCode", "BookingCurrency")]
TYPES = {"PassengerID": "long", "BookingID": "long", "PersonID": "long", "BookedByAgentID": "long",
         "Revenue": "double", "BookingDate": "date"}
UNFILLED = {"PassengerID", "PersonID", "ProvisionalPrimaryKey", "BookingDate", "TravelDestination"}
COLUMNS = [r["attributeName"] for r in RULES if r["attributeName"] != "Ignored"] + \
          [t for _, _, t in DIRECT]

CONFIG = {
    "attributeMapping": RULES,
    "columnMapping": [{"sourceEntity": e, "sourceColumn": c, "targetColumn": t}
                      for e, c, t in DIRECT],
    "profileSchema": [{"columnName": c, "dataType": TYPES.get(c, "string"),
                       "defaultValue": None if c in UNFILLED else
                       (0 if c in TYPES else fixed.UNKNOWN)} for c in COLUMNS],
}
AS_OF = "2001-01-01"


def entities(spark, sf) -> dict:
    return derive_all(spark, sf, ENTITY_SQL)


def registered(spark, sf):
    return derive_all(spark, sf, {"registered": REGISTERED_SQL})["registered"]


def profiles(spark, sf):
    return profile.build_profiles(entities(spark, sf), CONFIG, registered(spark, sf),
                                  as_of=F.lit(AS_OF).cast("date"))


# --- check SQL -----------------------------------------------------------------------------

def _entity_ctes() -> str:
    parts = []
    for name, sql in ENTITY_SQL.items():
        where = fixed.ENTITY_PREDICATES.get(name)
        body = plain(sql)
        parts.append(f"{name} AS (SELECT * FROM ({body})" + (f" WHERE {where})" if where else ")"))
    return ",\n".join(parts)


def _fold(entity: str, key: str, code: str, values: list[str]) -> str:
    """Last-wins per code, by all folded values in config order, as a DuckDB map."""
    order = ", ".join(f"{v} := {v}" for v in values)
    maps = ", ".join(f"map_from_entries(list((code, last.{v}))) AS {v}" for v in values)
    return (f"(SELECT {key}, {maps} FROM (SELECT {key}, {code} AS code, "
            f"max(struct_pack({order})) AS last FROM {entity} WHERE {code} IS NOT NULL "
            f"GROUP BY 1, 2) GROUP BY 1)")


# The check's own list: entity, key, code, folded values.
_MAPS = {"all_bookingcontact": ("BookingID", "TypeCode", ["FirstName", "Address1", "City"]),
         "all_passengertraveldoc": ("PassengerID", "DocTypeCode", ["DocNumber"]),
         "all_fee": ("PassengerID", "FeeCode", ["Name"]),
         "all_traveldoc": ("PersonID", "DocTypeCode", ["DocNumber"]),
         "all_personphone": ("PersonID", "TypeCode", ["PhoneNumber"])}


def _folded(entity: str) -> str:
    key, code, values = _MAPS[entity]
    source = "named_fee" if entity == "all_fee" else entity
    return f"{entity}_map AS {_fold(source, key, code, values)}"


def _latest(entity: str, key: str) -> str:
    return (f"{entity}_passport AS (SELECT {key}, DocNumber FROM {entity} WHERE "
            f"upper(DocTypeCode) = 'P' AND ({key}, ExpirationDate) IN (SELECT {key}, "
            f"max(ExpirationDate) FROM {entity} WHERE upper(DocTypeCode) = 'P' GROUP BY 1))")


def _path(name: str, entity: str, seq: str, value: str) -> str:
    return (f"{name} AS (SELECT PassengerID, string_agg({value}, '_' ORDER BY {seq}, {value}) "
            f"AS {value} FROM (SELECT DISTINCT PassengerID, {seq}, {value} FROM {entity}) GROUP BY 1)")


def _first_code(codes) -> str:
    return "coalesce(" + ", ".join(f"fee.Name['{c}']" for c in codes) + ")"


JOINED = f"""{_entity_ctes()},
named_fee AS (SELECT PassengerID, f.FeeCode, n.Name FROM all_passengerfee f
  LEFT JOIN all_fee n ON f.FeeCode = n.FeeCode),
{_latest("all_passengertraveldoc", "PassengerID")},
{_latest("all_traveldoc", "PersonID")},
{_path("legs", "all_passengerjourneyleg", "SegmentID, LegNumber", "UnitDesignator")},
{_path("stops", "all_passengerjourneysegment", "JourneyNumber, SegmentNumber", "ArrivalStation")},
{", ".join(_folded(e) for e in _MAPS)},
party AS (SELECT BookingID, CASE WHEN count(DISTINCT PassengerID) > 1 THEN 'Group' ELSE 'Solo' END
  AS TravelSoloOrGroup FROM all_bookingpassenger GROUP BY 1),
wide AS (SELECT b.BookingID, b.RecordLocator, b.BookingUTC, b.Revenue, b.CurrencyCode, b.ChannelType,
  a.AgentID, bp.PassengerID, p.PersonID, p.PersonType, n.FirstName AS n_first, n.LastName AS n_last,
  e.EmailAddress, ph.PhoneNumber AS phones, ad.Address1 AS pa1, ad.City AS pa_city,
  ad.Country AS pa_country, td.DocNumber AS person_docs, tp.DocNumber AS person_passport,
  pay.PaymentMethodCode, c.FirstName AS c_first, c.Address1 AS c_addr, c.City AS c_city,
  party.TravelSoloOrGroup, xa.Address1 AS xa1, xa.City AS xa_city, xa.Country AS xa_country,
  xa.Phone AS xa_phone, xd.DocNumber AS docs, xp.DocNumber AS passport, s.DepartureStation,
  s.DepartureDate, stops.ArrivalStation AS destination, legs.UnitDesignator AS seats, fee.Name AS fees,
  fee AS fee
 FROM all_booking b FULL JOIN all_agent a ON b.CreatedUserID = a.AgentID
 LEFT JOIN all_bookingpassenger bp ON b.BookingID = bp.BookingID
 LEFT JOIN all_person p ON a.PersonID = p.PersonID
 LEFT JOIN all_personname n ON p.PersonID = n.PersonID
 LEFT JOIN all_personemail e ON p.PersonID = e.PersonID
 LEFT JOIN all_personphone_map ph ON p.PersonID = ph.PersonID
 LEFT JOIN all_personaddress ad ON p.PersonID = ad.PersonID
 LEFT JOIN all_traveldoc_map td ON p.PersonID = td.PersonID
 LEFT JOIN all_traveldoc_passport tp ON p.PersonID = tp.PersonID
 LEFT JOIN all_payment pay ON b.BookingID = pay.BookingID
 LEFT JOIN all_bookingcontact_map c ON b.BookingID = c.BookingID
 LEFT JOIN party ON b.BookingID = party.BookingID
 LEFT JOIN all_passengeraddress xa ON bp.PassengerID = xa.PassengerID
 LEFT JOIN all_passengertraveldoc_map xd ON bp.PassengerID = xd.PassengerID
 LEFT JOIN all_passengertraveldoc_passport xp ON bp.PassengerID = xp.PassengerID
 LEFT JOIN (SELECT * FROM all_passengerjourneysegment WHERE JourneyNumber = 1 AND SegmentNumber = 1) s
   ON bp.PassengerID = s.PassengerID
 LEFT JOIN stops ON bp.PassengerID = stops.PassengerID
 LEFT JOIN legs ON bp.PassengerID = legs.PassengerID
 LEFT JOIN all_fee_map fee ON bp.PassengerID = fee.PassengerID),
flagged AS (SELECT *, CASE WHEN xa_city IS NULL THEN CASE WHEN pa_country IS NULL THEN 'No' ELSE 'Yes' END
   WHEN xa_city = pa_country THEN 'Yes' ELSE 'No' END AS IsRegistered FROM wide),
mapped AS (SELECT TravelSoloOrGroup, PersonID,
  cast(PassengerID AS VARCHAR) || '_' || cast(PersonID AS VARCHAR) AS ProvisionalPrimaryKey, IsRegistered,
  CASE WHEN IsRegistered = 'Yes' THEN n_first ELSE xa1 END AS FirstName,
  CASE WHEN IsRegistered = 'Yes' THEN n_last ELSE xa_country END AS LastName,
  regexp_replace(CASE WHEN IsRegistered = 'Yes' THEN phones[map_keys(phones)[1]] ELSE xa_phone END,
    '[^0-9]', '', 'g') AS Phone,
  CASE WHEN IsRegistered = 'Yes' THEN person_passport ELSE passport END AS PassportNumber,
  CASE WHEN IsRegistered = 'Yes' THEN concat_ws(' ', pa1, pa_city, pa_country)
    ELSE concat_ws(' ', xa1, xa_city, xa_country) END AS StreetAddress,
  CASE WHEN IsRegistered = 'Yes' THEN person_docs['OAFF'] ELSE docs['OAFF'] END AS GoID,
  CASE WHEN IsRegistered = 'Yes' THEN person_docs['S'] ELSE docs['S'] END AS SeniorCitizenID,
  AgentID AS BookedByAgentID, seats AS TravelSeat, DepartureStation AS TravelOrigin,
  DepartureDate AS TravelDate, {_first_code(fixed.BAGGAGE_CODES)} AS TravelBaggage,
  {_first_code(fixed.MEAL_CODES)} AS TravelMeals, {_first_code(fixed.INSURANCE_CODES)} AS TravelInsurance,
  docs['OAFF'] AS GoKeyedIn, CASE WHEN PassengerID IS NOT NULL THEN 'Yes' ELSE 'No' END AS IsPassenger,
  CASE WHEN IsRegistered = 'No' AND (docs['CEB'] IS NOT NULL OR person_docs['CEB'] IS NOT NULL)
    THEN 'Yes' ELSE 'No' END AS IsEmployee,
  CASE WHEN IsRegistered = 'No' AND (docs['CEBD'] IS NOT NULL OR person_docs['CEBD'] IS NOT NULL)
    THEN 'Yes' ELSE 'No' END AS IsEmployeeDependent,
  destination AS TravelDestination, n_last AS BookerLastName, n_first AS BookerFirstName,
  EmailAddress AS BookerEmailAddress, pa_city AS BookerCity, person_passport AS BookerPassportNumber,
  CASE PersonType WHEN 0 THEN 'None' WHEN 1 THEN 'Customer' WHEN 2 THEN 'Agent' END AS BookerType,
  phones['M'] AS BookerMobile, phones['H'] AS BookerHomePhone,
  concat_ws(', ', pa1, pa_city, pa_country) AS BookerStreetAddress, person_docs['GG'] AS BookerGoID,
  c_first['P'] AS PrimaryContact, c_first['W'] AS AdditionalContact,
  concat_ws(', ', c_first['P'], c_addr['P'], c_city['P']) AS PrimaryContactAddress,
  concat_ws(', ', c_first['W'], c_addr['W'], c_city['W']) AS AdditionalContactAddress,
  CASE ChannelType WHEN 0 THEN 'Default' WHEN 1 THEN 'Direct' WHEN 2 THEN 'Web' WHEN 3 THEN 'GDS'
    WHEN 4 THEN 'API' END AS BookingChannel, PaymentMethodCode AS PaymentMethod,
  PassengerID, BookingID, RecordLocator, cast(BookingUTC AS DATE) AS BookingDate, Revenue,
  CurrencyCode AS BookingCurrency FROM flagged)"""


def _filled(c: str) -> str:
    if c in UNFILLED:
        return f"max({c}) AS {c}"
    default = "0" if c in TYPES else f"'{fixed.UNKNOWN}'"
    return f"coalesce(max({c}), {default}) AS {c}"


PROFILES = f"""{JOINED},
golden AS (SELECT ProvisionalPrimaryKey,
  {", ".join(_filled(c) for c in COLUMNS if c != "ProvisionalPrimaryKey")}
  FROM mapped GROUP BY ProvisionalPrimaryKey),
registered AS (SELECT lower(email) AS ciam_email, balance AS ciam_balance
  FROM ({plain(REGISTERED_SQL)})),
vouched AS (SELECT DISTINCT b.BookingID FROM all_booking b
  JOIN all_payment p ON b.BookingID = p.BookingID AND p.PaymentMethodCode = 'VO'
  JOIN all_voucher v ON v.VoucherReference = p.AccountNumber AND v.Amount > v.Available
  WHERE cast(b.BookingUTC AS DATE) <= DATE '{AS_OF}' - 1 AND b.Status IN (2, 3)
   AND v.voucherbasiscode IN ({", ".join(f"'{c}'" for c in fixed.VOUCHER_BASIS_CODES)})
   AND p.AuthorizationStatus = 4 AND v.status = 1),
enriched AS (SELECT g.* REPLACE (lower(g.BookerEmailAddress) AS BookerEmailAddress), r.ciam_email,
  r.ciam_balance, CASE WHEN v.BookingID IS NULL THEN 'no' ELSE 'yes' END AS IsCsp
  FROM golden g LEFT JOIN registered r
   ON lower(g.BookerEmailAddress) = r.ciam_email AND g.IsRegistered = 'Yes'
  LEFT JOIN vouched v ON g.BookingID = v.BookingID
  WHERE g.BookingID NOT IN (SELECT b.BookingID FROM all_booking b
    JOIN all_voucher u ON b.RecordLocator = u.RecordLocator)),
profiles AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY PassengerID ORDER BY ProvisionalPrimaryKey NULLS FIRST) AS rn FROM enriched) WHERE rn = 1)"""


@query("profile_build", f"WITH {PROFILES} SELECT * FROM profiles")
def profile_build(spark, sf):
    return profiles(spark, sf)


@query("attribute_mapping", f"""WITH {JOINED}
SELECT * FROM mapped""")
def attribute_mapping(spark, sf):
    """All 31 attribute rules on the joined rows, before the collapse."""
    raw = apply_predicates(entities(spark, sf))
    tables = profile.fold_entities(profile.derive_tables(raw), needed=required_columns(CONFIG))
    rows = map_attributes(profile.join_entities(tables), RULES, CONFIG["columnMapping"])
    rows = rows.select(*COLUMNS)
    return rows.withColumns({"Phone": F.regexp_replace("Phone", "[^0-9]", ""),
                             "BookingDate": F.col("BookingDate").cast("date")})


# --- serving ---------------------------------------------------------------------------------

def serving_input(spark, sf):
    """Profiles with the identity and name columns the serving tables expect."""
    rows = stored(profiles(spark, sf))
    named = {"MiddleName": F.lit(None).cast("string"), "HonorificPrefix": F.lit("Ms"),
             "HonorificSuffix": F.lit(""), "EmailAddress": F.col("BookerEmailAddress"),
             "Gender": F.when(F.col("TravelOrigin") == "O1", "F").otherwise("M"),
             "DateOfBirth": F.when(F.col("LastName") == "A", fixed.UNKNOWN)
                             .otherwise(F.col("TravelDate")),
             "Zipcode": F.col("GoID"), "Nationality": F.col("LastName"),
             "City": F.col("BookerCity"), "State": F.lit("S")}
    # The identity stage without clusters: everyone gets the fallback identity.
    nobody = spark.createDataFrame([], "provisionalprimarykey string, passenger_hash string")
    rows = unify_profiles(rows.withColumns(named), nobody).profiles
    # Decimal revenue, so that sums do not depend on the order of the rows.
    return rows.withColumn("Revenue", F.col("Revenue").cast("decimal(18,2)"))


RATES = {"PHP": 1.0, "USD": 0.5, "JPY": 2.0}


def serving_rows(spark, sf):
    rows = serving.serving_rows(serving_input(spark, sf), F.lit(AS_OF).cast("date"), RATES)
    rows = rows.withColumn("New_Revenue", F.col("New_Revenue").cast("decimal(18,3)"))
    # Statistics, histograms and timelines all start from these rows.
    return stored(rows)


_BANDS = " ".join(f"WHEN a BETWEEN {n} AND {n + 9} THEN '{n}_to_{n + 9}'" for n in range(1, 100, 10))
SERVED = f"""{PROFILES},
named AS (SELECT *, md5(lower(coalesce(FirstName, 'Unknown')) || '_' || lower(coalesce(LastName, 'Unknown'))
   || '_' || coalesce(DateOfBirth, '{fixed.NULL_TOKEN}')) AS passenger_hash FROM (
 SELECT *, NULL::VARCHAR AS MiddleName, 'Ms' AS HonorificPrefix, '' AS HonorificSuffix,
  BookerEmailAddress AS EmailAddress, CASE WHEN TravelOrigin = 'O1' THEN 'F' ELSE 'M' END AS Gender,
  CASE WHEN LastName = 'A' THEN 'Unknown' ELSE TravelDate END AS DateOfBirth, GoID AS Zipcode,
  LastName AS Nationality, BookerCity AS City, 'S' AS State,
  monthname(BookingDate) AS BookingMonth,
  cast(cast(Revenue AS DECIMAL(18,2)) * CASE BookingCurrency WHEN 'PHP' THEN 1.0 WHEN 'USD' THEN 0.5
    WHEN 'JPY' THEN 2.0 END AS DECIMAL(18,3)) AS New_Revenue FROM profiles)),
served AS (SELECT * EXCLUDE (a), CASE WHEN DateOfBirth = 'Unknown' THEN 'Unknown' {_BANDS}
  ELSE 'Above100' END AS AgeRange FROM (SELECT *, year(DATE '{AS_OF}') -
   year(try_cast(DateOfBirth AS DATE)) AS a FROM named))"""


@query("index_milestone", f"""WITH {SERVED} SELECT count(DISTINCT passenger_hash) AS customers,
 count(DISTINCT PassengerID) AS journeys, count(DISTINCT PersonID) AS bookers,
 count(DISTINCT BookingID) AS bookings FROM served""")
def index_milestone(spark, sf):
    return serving.index_milestone(serving_rows(spark, sf))


@query("revenue_breakdown", f"""WITH {SERVED} SELECT BookingCurrency, cast(sum(r) AS DOUBLE) AS Revenue
 FROM (SELECT max(New_Revenue) AS r, max(BookingCurrency) AS BookingCurrency FROM served
 GROUP BY BookingID) GROUP BY 1""")
def revenue_breakdown(spark, sf):
    out = serving.revenue_breakdown(serving_rows(spark, sf))
    return out.withColumn("Revenue", F.col("Revenue").cast("double"))


# Every indicator column and its values in the test data, written out: the query reads them
# from its rows.
_PASSENGER_CELLS = {
    "BookingMonth": ["January", "February", "March", "April", "May", "June", "July", "August",
                     "September", "October", "November", "December"],
    "TravelMeals": ["Unknown", "fee small"],
    "BookingChannel": ["API", "Default", "Direct", "Unknown", "Web"],
    "TravelBaggage": ["Unknown", "fee economy", "fee promo"],
    "TravelInsurance": ["Unknown", "fee standard"],
    "BookingCurrency": ["JPY", "PHP", "USD"],
    "IsRegistered": ["No", "Yes"],
    "TravelSoloOrGroup": ["Group", "Solo"],
}
_BOOKER_CELLS = _PASSENGER_CELLS | {
    "IsEmployee": ["No", "Yes"],
    "Gender": ["F", "M"],
    "IsEmployeeDependent": ["No", "Yes"],
    "AgeRange": ["1_to_10", "Above100", "Unknown"],
}


_PASSENGER_TEXT = ["FirstName", "MiddleName", "LastName", "HonorificPrefix", "HonorificSuffix", "EmailAddress",
                   "Phone", "Gender", "ProvisionalPrimaryKey", "DateOfBirth", "Zipcode", "Nationality", "City",
                   "State"]
_BOOKER_TEXT = ["BookerFirstName", "BookerLastName", "BookerEmailAddress", "BookerMobile", "BookerType",
                "BookerCity"]


def _cells(cells: dict) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {c} = '{v}') AS {c}_separator_{v.replace(' ', '_space1_')}"
        for c, values in cells.items() for v in values)


def _histogram(key: str, column: str, cap: int | None, unknown: bool) -> str:
    value = f"coalesce(nullif(trim({column}), ''), 'Unknown')" if unknown else \
        f"CASE WHEN {column} = '' THEN 'Unknown' ELSE {column} END"
    where = "" if unknown else f"WHERE {column} IS NOT NULL"
    top = "" if cap is None else f"WHERE r <= {cap}"
    return (f"(SELECT {key}, '{{' || string_agg('\"' || v || '\":' || n, ',' ORDER BY r) || '}}' AS {column} "
            f"FROM (SELECT {key}, {value} AS v, count(*) AS n, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY count(*) DESC, {value}) AS r FROM served {where} GROUP BY 1, 2) {top} GROUP BY 1)")


FIELDS = [("origin", "TravelOrigin"), ("destination", "TravelDestination"),
          ("insurance", "TravelInsurance"), ("baggage", "TravelBaggage"), ("meals", "TravelMeals"),
          ("travel_date", "string_split(TravelDate, ' ')[1]"),
          ("booking_date", "cast(BookingDate AS VARCHAR)")]


def _timeline(key: str, revenue: str, currency: bool) -> str:
    fields = FIELDS + [("revenue", f"cast(cast({revenue} AS DOUBLE) AS VARCHAR)"), ("record_locator", "RecordLocator"),
                       ("IsCsp", "IsCsp")] + ([("currency", "BookingCurrency")] if currency else [])
    body = ", ".join(f"'\"{name}\":\"' || {sql} || '\"'" for name, sql in fields)
    return (f"(SELECT {key}, '{{' || string_agg('\"' || (rn - 1) || '\":{{' || body || '}}', ',' ORDER BY rn) "
            f"|| '}}' AS Details FROM (SELECT {key}, concat_ws(',', {body}) AS body, row_number() OVER ("
            f"PARTITION BY {key} ORDER BY TravelDate DESC NULLS LAST, PassengerID NULLS FIRST) AS rn FROM served) "
            f"WHERE rn <= 250 GROUP BY 1)")


def _per_key(key: str, texts, count: str, extra: str, cap: int | None, unknown: bool,
             revenue: str, currency: bool, cells: dict) -> str:
    return f"""WITH {SERVED},
stats AS (SELECT {key}, {", ".join(f"max({c}) AS {c}" for c in texts)},
  cast(max(BookingDate) AS VARCHAR) AS LatestDate, cast(min(BookingDate) AS VARCHAR) AS FirstDate,
  count(PassengerID) AS {count}, cast(sum(New_Revenue) AS DOUBLE) AS TotalRevenue, {_cells(cells)}{extra}
  FROM served GROUP BY 1)
SELECT s.*, coalesce(o.TravelOrigin, '{{}}') AS TravelOrigin,
 coalesce(d.TravelDestination, '{{}}') AS TravelDestination, coalesce(t.TravelSeat, '{{}}') AS TravelSeat,
 l.Details FROM stats s JOIN {_timeline(key, revenue, currency)} l ON s.{key} = l.{key}
 LEFT JOIN {_histogram(key, "TravelOrigin", cap, unknown)} o ON s.{key} = o.{key}
 LEFT JOIN {_histogram(key, "TravelDestination", cap, unknown)} d ON s.{key} = d.{key}
 LEFT JOIN {_histogram(key, "TravelSeat", cap, unknown)} t ON s.{key} = t.{key}"""


def _plain_types(df):
    return df.withColumns({"TotalRevenue": F.col("TotalRevenue").cast("double"),
                           "LatestDate": F.col("LatestDate").cast("string"),
                           "FirstDate": F.col("FirstDate").cast("string")})


@query("passenger_details", _per_key("passenger_hash", _PASSENGER_TEXT, "TotalBookings", "", 50,
                                     False, "cast(Revenue AS DECIMAL(18,2))", False, _PASSENGER_CELLS))
def passenger_details(spark, sf):
    return _plain_types(serving.passenger_details(serving_rows(spark, sf)))


@query("booker_details", _per_key("PersonID", _BOOKER_TEXT, "TotalPassengers",
                                  ", count(DISTINCT passenger_hash) AS UniqueClients", None, True,
                                  "New_Revenue", True, _BOOKER_CELLS))
def booker_details(spark, sf):
    return _plain_types(serving.booker_details(serving_rows(spark, sf)))
