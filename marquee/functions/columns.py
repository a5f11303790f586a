"""Business attributes as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import schemas
from marquee.functions.amounts import usable


def band(value: Column, bands: Sequence[tuple[float, str]], rest: str, null_label: str | None = None) -> Column:
    """Label of the first band whose exclusive upper bound exceeds the value.

    A null value falls through to ``rest`` unless ``null_label`` gives it a label of its own.
    """
    chain = F.when(value.isNull(), F.lit(null_label)) if null_label is not None else F
    for bound, label in bands:
        chain = chain.when(value < bound, label)
    return chain.otherwise(rest)


def age_in(year: int, dob: Column) -> Column:
    return (F.lit(year) - F.year(dob)).cast("int")


def age_group(age: Column, null_label: str | None = None) -> Column:
    return band(age, schemas.AGE_BANDS, schemas.AGE_REST, null_label)


def show_session(hour: Column, null_label: str | None = None) -> Column:
    return band(hour, schemas.SESSION_BANDS, schemas.SESSION_REST, null_label)


def piece(text: Column, separator: str, position: int) -> Column:
    """Part of a delimited text; null when the text is too short."""
    return F.get(F.split(text, separator), F.lit(position))


def address_part(address: Column, position: int) -> Column:
    return F.trim(piece(address, "/", position))


def whole_number(text: Column) -> Column:
    """Integer part of a numeric text, else null.

    The pattern keeps other texts away from the cast, which would raise and catch an
    exception for each of them.
    """
    digits = F.regexp_extract(text, r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def finite_number(text: Column) -> Column:
    """Number of a text, else null; also null for one that is no amount (see ``amounts``)."""
    return usable(text.try_cast("double"))


def hour_of_clock(clock: Column) -> Column:
    """Hour of an ``HH:mm`` text; null when it is not a number."""
    return whole_number(piece(clock, ":", 0))


def first_number(text: Column) -> Column:
    """First run of digits in a text as an integer, else null."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int")


def gender_label(code: Column, codes: Mapping[str, Sequence[str]] = schemas.GENDER_CODES) -> Column:
    chain = F
    for label, accepted in codes.items():
        chain = chain.when(F.upper(code).isin(*accepted), label)
    return chain.otherwise(schemas.GENDER_REST)


def channel(customer_id: Column) -> Column:
    return F.when(customer_id.startswith(schemas.ONLINE_PREFIX), "Online").otherwise("Offline")


def is_yes(text: Column, yes: str = schemas.POPCORN_YES, null_value: bool | None = False) -> Column:
    hit = F.trim(text) == yes
    return hit if null_value is None else F.coalesce(hit, F.lit(null_value))


def is_couple(slot_type: Column) -> Column:
    """True for couple seats, whatever the case or padding of the text."""
    return F.coalesce(F.upper(F.trim(slot_type)) == schemas.COUPLE_SEAT, F.lit(False))


def iso_weekday(day: Column) -> Column:
    """Monday 1 ... Sunday 7."""
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def is_missing(column: str, dtype: str) -> Column:
    """Null, or an empty text."""
    missing = F.col(column).isNull()
    return missing | (F.col(column) == "") if dtype == "string" else missing
