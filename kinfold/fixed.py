"""Fixed values.

Plain lists and constants whose content decides results (placeholder names,
document and fee codes, sentinels).  Every function that uses one takes it as
a parameter, so a deployment can pass its own.
"""

# --- sentinels -------------------------------------------------------------
NULL_TOKEN = "CCAI_NULL"
UNKNOWN = "Unknown"
FAILED_NAME = "xxx"
OPEN_END = "9999-12-31 00:00:00.000"
UNKNOWN_DOB_PREFIX = "9999"
MASKED_DOB = "%xxx%"

# --- name standardisation ----------------------------------------------------
FIRST_NAME_PLACEHOLDERS = [
    "tba", "adt1", "adt2", "pax", "fname", "first", "xxx", "firstname", "api",
    "anonymous", "cebitcc", "ntba", "test", "itcc", "sherwin",
]
LAST_NAME_PLACEHOLDERS = [
    "tbaa", "last", "aaa", "adt1", "adt2", "bcs", "pax", "tba", "lname", "xxx",
    "andrada", "commandcenter", "ceb", "lastname",
]
INDEX_EXTRA_PLACEHOLDERS = ["unknown", "ccainull"]
HONORIFICS = ["mr", "ms", "dr", "rev", "prof", "sir", "madam", "miss", "mrs", "st"]
JUNIOR_REWRITE = " junior alias son of jr"
FIRST_NAME_THRESHOLD = 0.85
LAST_NAME_THRESHOLD = 0.90
QUARANTINED_FIRST_KEYS = ["TV"]
QUARANTINED_LAST_KEYS = ["TV", "PX"]
PLAUSIBLE_DOB_FROM = "1947-01-01"
PLAUSIBLE_DOB_BEFORE = "2023-12-12"

# --- entity predicates ---------------------------------------------------------
ENTITY_PREDICATES = {
    "all_bookingcontact": "TypeCode IN ('P', 'W')",
    "all_passengertraveldoc": "DocTypeCode IN ('OAFF', 'S', 'P', 'CEB', 'CEBD')",
    "all_personname": "NameType = 1",
    "all_personemail": "IsDefault = true",
    "all_traveldoc": "DocTypeCode IN ('OAFF', 'S', 'P', 'CEB', 'GG', 'CEBD')",
    "all_personaddress": "IsDefault = true",
    "all_personphone": "IsDefault = true AND TypeCode IN ('M', 'H')",
    "all_booking": "Status != 4",
}

# --- source layout -------------------------------------------------------------
VERSIONED_ENTITIES = [
    "all_booking", "all_passengerjourneysegment", "all_passengerfee",
    "all_passengerjourneyleg",
]
AUDIT_COLUMNS = [
    "rowid", "s_startdt", "s_starttime", "s_enddt", "s_endtime",
    "s_deleted_flag", "c_journaltime", "c_transactionid", "c_operationtype",
    "c_userid",
]

# --- fee and document codes ------------------------------------------------------
BAGGAGE_CODES = [
    "BAG35", "BAG45", "EXSBAG", "PC32", "BAG10", "IBAG", "XBAG", "BAG25",
    "BAGPRO", "BAG32", "PC20", "XNBAG", "PBAG", "BAG30", "GBAG", "FLYBAG",
    "BAG40", "BAG20", "OVSBAG", "APTBAG", "BAG15",
]
MEAL_CODES = ["MEAL", "MEAL1", "MEAL2", "MEAL3", "MEAL4", "MEAL5"]
INSURANCE_CODES = [
    "NSURAD", "NSURAR", "NSURCD", "NSURCR", "NSURIN", "NSURIR", "ININF2",
    "ININFO", "ININFR", "INS", "INSCDO", "INSCDR", "INSLH1", "INSLH2", "INSOW",
    "INSRT", "INSRT2",
]
BOOKER_TYPES = {0: "None", 1: "Customer", 2: "Agent"}
BOOKING_CHANNELS = {0: "Default", 1: "Direct", 2: "Web", 3: "GDS", 4: "API"}

# --- voucher-paid bookings ---------------------------------------------------------
VOUCHER_PAYMENT_METHOD = "VO"
VOUCHER_BASIS_CODES = ["99PHP", "99CSP2", "99CSP3", "99CSP4", "99CSP5"]
VOUCHER_BOOKING_STATUSES = [2, 3]
VOUCHER_AUTHORIZATION_STATUS = 4
VOUCHER_STATUS = 1

# --- serving -------------------------------------------------------------------------
HOME_CURRENCY = "PHP"
LOCAL_OFFSET_HOURS = 8
CURRENCY_RATES = {
    "THB": 0.657845, "AED": 13.203984, "MYR": 7.624044, "EUR": 0.011741,
    "OMR": 0.001127, "KWD": 0.003423, "VND": 254.181015, "USD": 0.019467,
    "AUD": 0.025128, "CNY": 0.126146, "PHP": 1.0, "KRW": 22.734294,
    "JPY": 2.180405, "HKD": 0.151516, "TWD": 0.539236, "QAR": 0.071024,
    "MOP": 0.156013, "IDR": 278.384131, "SAR": 0.073001, "INR": 1.427856,
    "BHD": 0.007356, "SGD": 0.026176, "BND": 0.026101,
}
PIVOT_CHAR_NAMES = {" ": "_space1_", "-": "_space2_", "(": "_space3_", ")": "_space4_"}
PASSENGER_INDICATORS = [
    "BookingMonth", "TravelMeals", "BookingChannel", "TravelBaggage",
    "TravelInsurance", "BookingCurrency", "IsRegistered", "TravelSoloOrGroup",
]
BOOKER_INDICATORS = [
    "BookingMonth", "TravelMeals", "BookingChannel", "IsEmployee",
    "TravelBaggage", "Gender", "IsEmployeeDependent", "TravelInsurance",
    "TravelSoloOrGroup", "IsRegistered", "BookingCurrency", "AgeRange",
]
TIMELINE_ROWS = 250
HISTOGRAM_VALUES = 50
MAX_RECORDS_PER_FILE = 100_000
