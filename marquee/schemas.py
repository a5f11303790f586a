"""Column layouts and fixed labels."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the raw columns after header cleaning, all read as text.
RAW_FILM = [
    "show_id", "film_name", "director", "cast", "country",
    "release_year", "rating", "duration", "listed_in", "description",
]
RAW_CUSTOMER = ["customerid", "dob", "gender", "address", "job"]
RAW_TICKET = [
    "orderid", "cashier", "saledate", "total", "customerid", "ticketcode", "date", "time",
    "slot", "room", "film", "slot_type", "ticket_type", "ticket_price", "popcorn",
]

# Age bands by exclusive upper bound, then the label of the rest.
AGE_BANDS = [(20, "Dưới 20"), (30, "20-29"), (40, "30-39"), (50, "40-49")]
AGE_REST = "50+"
AGE_ORDER = ["Dưới 20", "20-29", "30-39", "40-49", "50+"]

# Show-time bands by exclusive upper hour, then the label of the rest.
SESSION_BANDS = [(12, "Sáng"), (17, "Chiều"), (20, "Tối sớm")]
SESSION_REST = "Tối muộn"
SESSION_ORDER = ["Sáng", "Chiều", "Tối sớm", "Tối muộn"]

# Gender codes (compared in upper case) and their labels.
GENDER_CODES = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}
GENDER_CODES_VI = {"Male": ["M", "MALE", "NAM"], "Female": ["F", "FEMALE", "NỮ"]}
GENDER_REST = "Other"
GENDER_ORDER = ["Female", "Male", "Other"]

# Flags, prefixes and labels in the raw files and reports.
POPCORN_YES = "Có"
COUPLE_SEAT = "ĐÔI"
ONLINE_PREFIX = "WEBS"
WEEKEND_LABEL, WEEKDAY_LABEL = "Cuối tuần", "Ngày thường"
POPCORN_LABEL, NO_POPCORN_LABEL = "Có bắp rang", "Không bắp rang"
UNKNOWN = "Unknown"

# Amounts are stored as double; a sum of them becomes this exact decimal.
AMOUNT_SUM = T.DecimalType(38, 15)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

DIM_CUSTOMER = _struct(
    ("customer_id", _S), ("dob", T.DateType()), ("age_2019", _I), ("age_group", _S),
    ("gender", _S), ("district", _S), ("city", _S), ("job", _S), ("customer_type", _S),
)
DIM_FILM = _struct(
    ("film_name", _S), ("country", _S), ("director", _S), ("rating", _S), ("duration", _I),
)
DIM_DATE = _struct(
    ("sale_date", T.DateType()), ("day", _I), ("month", _I), ("year", _I), ("day_of_week", _I),
    ("day_name", _S), ("month_name", _S), ("week_of_year", _I), ("quarter", _I), ("is_weekend", _B),
)
FACT_TICKET = _struct(
    ("order_id", _S), ("ticket_id", _S), ("customer_id", _S), ("film_name", _S),
    ("sale_date", T.DateType()), ("is_weekend", _B), ("sale_hour", _I), ("time", _S),
    ("show_hour", _I), ("show_session", _S), ("slot", _S), ("room", _I), ("slot_type", _S),
    ("is_couple_seat", _B), ("ticket_type", _S), ("ticket_price", _D), ("total", _D),
    ("has_popcorn", _B), ("cashier", _S),
)
FACT_PARTITIONS = ["sale_year", "sale_month"]
