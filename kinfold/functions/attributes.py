"""Attribute rules: a config names a rule and its source columns.

Every rule is one Column expression over `s` (the source columns in config
order) and `reg` (the registered flag).  Eight primitives cover them all: copy,
joined key, registered switch, map lookup, first present code, code decode,
presence flag and multi-column text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed

REGISTERED = "IsRegistered"


def copied(s: Column) -> Column:
    return s


def joined_key(a: Column, b: Column, sep: str = "_") -> Column:
    return F.concat(a.cast("string"), F.lit(sep), b.cast("string"))


def switch(reg: Column, when_yes: Column, when_no: Column) -> Column:
    return F.when(reg == "Yes", when_yes).otherwise(when_no)


def lookup(m: Column, code: str) -> Column:
    return F.try_element_at(m, F.lit(code))


def first_value(m: Column) -> Column:
    return F.try_element_at(F.map_values(m), F.lit(1))


def first_present(m: Column, codes: Sequence[str]) -> Column:
    return F.coalesce(*[lookup(m, c) for c in codes])


def decode(c: Column, names: Mapping[int, str]) -> Column:
    out = F.lit(None).cast("string")
    for code, label in reversed(list(names.items())):
        out = F.when(c == code, label).otherwise(out)
    return out


def yes_no(cond: Column) -> Column:
    return F.when(cond, "Yes").otherwise("No")


def text_of(sep: str, *parts: Column) -> Column:
    return F.concat_ws(sep, *[p.cast("string") for p in parts])


def is_registered(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """First pair absent: registered when the second pair is there at all.
    Otherwise registered only when both pairs agree."""
    absent = a1.isNull() & a2.isNull()
    return F.when(absent, yes_no(b1.isNotNull() | b2.isNotNull())) \
            .otherwise(yes_no((a1 == b1) & (a2 == b2)))


def employee_flag(reg: Column, docs: Sequence[Column], code: str) -> Column:
    held = F.coalesce(*[lookup(m, code) for m in docs]).isNotNull()
    return yes_no((reg == "No") & held)


FEE_CODES = {"TravelBaggage": fixed.BAGGAGE_CODES, "TravelMeals": fixed.MEAL_CODES,
             "TravelInsurance": fixed.INSURANCE_CODES}

# rule name → f(sources, registered flag, attribute name)
RULES: dict[str, Callable[[Sequence[Column], Column, str], Column]] = {
    "GetTravelSoloOrGroup": lambda s, reg, name: copied(s[0]),
    "GetPersonID": lambda s, reg, name: copied(s[0]),
    "GetProvisionalPrimaryKey": lambda s, reg, name: joined_key(s[0], s[1]),
    "GetIsRegistered": lambda s, reg, name: is_registered(*s[:4]),
    "GetDetails": lambda s, reg, name: switch(reg, s[1], s[0]),
    "GetDetailsPhone": lambda s, reg, name: switch(reg, first_value(s[1]), s[0]),
    "GetPassportNumber": lambda s, reg, name: switch(reg, s[1], s[0]),
    "GetStreetAddress": lambda s, reg, name: switch(
        reg, text_of(" ", *s[3:6]), text_of(" ", *s[0:3])),
    "GetGoIdFun": lambda s, reg, name: switch(reg, lookup(s[1], "OAFF"), lookup(s[0], "OAFF")),
    "GetSeniorCitizenID": lambda s, reg, name: switch(reg, lookup(s[1], "S"), lookup(s[0], "S")),
    "GetBookedByAgentID": lambda s, reg, name: copied(s[0]),
    "GetTravelSeat": lambda s, reg, name: copied(s[0]),
    "GetTravelOriginAndDate": lambda s, reg, name: copied(s[0]),
    "GetTravelBaggageMealsInsurance": lambda s, reg, name: first_present(s[0], FEE_CODES[name]),
    "GetTravelGetGoKeyedIn": lambda s, reg, name: lookup(s[0], "OAFF"),
    "GetIsPassenger": lambda s, reg, name: yes_no(s[0].isNotNull()),
    "GetIsEmployee": lambda s, reg, name: employee_flag(reg, s[:2], "CEB"),
    "GetIsEmployeeDependent": lambda s, reg, name: employee_flag(reg, s[:2], "CEBD"),
    "GetTravelDestination": lambda s, reg, name: copied(s[0]),
    "GetBookerDetails": lambda s, reg, name: copied(s[0]),
    "GetBookerPassportNumber": lambda s, reg, name: copied(s[0]),
    "GetBookerType": lambda s, reg, name: decode(s[0], fixed.BOOKER_TYPES),
    "GetBookerMobile": lambda s, reg, name: lookup(s[0], "M"),
    "GetBookerHomePhone": lambda s, reg, name: lookup(s[0], "H"),
    "GetBookerStreetAddress": lambda s, reg, name: text_of(", ", *s[:3]),
    "GetBookerGetGoID": lambda s, reg, name: lookup(s[0], "GG"),
    "GetPrimaryNames": lambda s, reg, name: lookup(s[0], "P"),
    "GetAdditionalNames": lambda s, reg, name: lookup(s[0], "W"),
    "GetPrimaryContactStreetAddress": lambda s, reg, name: text_of(
        ", ", *[lookup(m, "P") for m in s[:3]]),
    "GetAdditionalContactStreetAddress": lambda s, reg, name: text_of(
        ", ", *[lookup(m, "W") for m in s[:3]]),
    "GetBookingChannel": lambda s, reg, name: decode(s[0], fixed.BOOKING_CHANNELS),
    "GetPaymentMethodCode": lambda s, reg, name: copied(s[0]),
}

# Rules that read a fixed joined column, whatever sources the config lists.
FIXED_SOURCES = {
    "GetTravelSoloOrGroup": ["GetTravelSoloOrGroup_all_bookingpassenger_TravelSoloOrGroup"],
    "GetPersonID": ["all_person_PersonID"],
    "GetProvisionalPrimaryKey": ["all_bookingpassenger_PassengerID", "all_person_PersonID"],
}
# Rules that read a derived table named after the entity.
DERIVED_SOURCES = {
    "GetPassportNumber": "GetPassportNumber_",
    "GetBookerPassportNumber": "GetPassportNumber_",
    "GetTravelDestination": "GetTravelDestination_",
}


def _sources(rule: Mapping) -> list[Column]:
    function = rule["transformationFunction"]
    if function in FIXED_SOURCES:
        return [F.col(c) for c in FIXED_SOURCES[function]]
    prefix = DERIVED_SOURCES.get(function, "")
    return [F.col(f"{prefix}{s['entityName']}_{s['columnName']}") for s in rule["sourceColumns"]]


def map_attributes(df: DataFrame, attribute_mapping: Sequence[Mapping],
                   column_mapping: Sequence[Mapping] = (),
                   rules: Mapping[str, Callable] = RULES) -> DataFrame:
    """Append the mapped columns.  Two projections: the registered flag and
    everything that does not need it order-free, then the rest; unknown rule
    names are ignored."""
    direct = [F.col(f"{m['sourceEntity']}_{m['sourceColumn']}").alias(m["targetColumn"])
              for m in column_mapping]
    flags = [r for r in attribute_mapping if r["transformationFunction"] == "GetIsRegistered"]
    others = [r for r in attribute_mapping
              if r["transformationFunction"] in rules and r not in flags]
    first = [rules["GetIsRegistered"](_sources(r), None, r["attributeName"])
             .alias(r["attributeName"]) for r in flags]
    df = df.select("*", *direct, *first)
    reg = F.col(REGISTERED) if REGISTERED in df.columns else F.lit(None).cast("string")
    return df.select("*", *[
        rules[r["transformationFunction"]](_sources(r), reg, r["attributeName"])
        .alias(r["attributeName"]) for r in others])
