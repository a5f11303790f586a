"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated: payment cards by their check digit, telephone
numbers and social security numbers by their numbering plan, IPv4 addresses by range,
dates by the calendar. A valid value is mapped to its place in the set of all valid values
of its kind, permuted there by a keyed Feistel network over two residues, and written in
the same format. The mapping is one to one and depends on the value only, so one value
has one pseudonym in all documents, however it is punctuated. Mail addresses keep their
domain; the letters and digits of the local part are permuted as base-36 numerals.
Everything else, values that fail validation included, stays as it is.

Defined cases: a null text stays null; dates outside 1900-01-01 to 2100-04-30 stay;
days come before months unless only the other order is a date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: What a value of each kind looks like; fixed values.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
ABROAD = r"(?<![0-9+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
KINDS = {"email": EMAIL, "date": DATE, "ssn": SSN, "phone": PHONE, "abroad": ABROAD, "ipv4": IPV4, "card": CARD}
ANY = "|".join(KINDS.values())

#: Days from 1900-01-01 that take part, as a product of two residues.
_DATE_RESIDUES = (271, 270)
#: Years from 1900 on whose month-first dates take part; 49 of them are leap years.
_LATE_YEARS = 200


def feistel(left: Column, right: Column, sizes: tuple, secret: str, tweak: Column) -> Column:
    """Permute pairs of residues (left mod sizes[0], right mod sizes[1]); gives a struct l, r."""
    size_l, size_r = (s if isinstance(s, Column) else F.lit(s).cast("long") for s in sizes)
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(held: Column, n: Column) -> Column:
        said = F.concat_ws("|", F.lit(secret), tweak, n.cast("string"), held["r"].cast("string"))
        noise = F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")
        size = F.when(n % 2 == 0, size_l).otherwise(size_r)
        return F.struct(held["r"].alias("l"), ((held["l"] + noise % size) % size).alias("r"))

    return F.aggregate(F.sequence(F.lit(1) - 1, F.lit(ROUNDS - 1)), start, turn)


def permuted_number(number: Column, sizes: tuple[int, int], secret: str, kind: str) -> Column:
    """Permute the numbers below the product of the two sizes."""
    out = feistel(F.floor(number / sizes[1]), number % sizes[1], sizes, secret, F.lit(kind))
    return F.aggregate(F.array(out), F.lit(0).cast("long"), lambda _, p: p["l"] * sizes[1] + p["r"])


def permuted_numerals(numerals: Column, base: int, secret: str, kind: str) -> Column:
    """Permute texts of up to 20 numerals of a base, length kept."""
    n = F.length(numerals)
    half = F.floor(n / 2).cast("int")
    size_l = F.pow(F.lit(float(base)), (n - half).cast("double")).cast("long")
    size_r = F.pow(F.lit(float(base)), half.cast("double")).cast("long")
    head, tail = F.substr(numerals, F.lit(1), n - half), F.substr(numerals, n - half + 1, half)
    value = lambda s: F.coalesce(F.conv(s, base, 10).cast("long"), F.lit(0).cast("long"))
    out = feistel(value(head), value(tail), (size_l, size_r), secret, F.concat(F.lit(kind), n.cast("string")))
    text = lambda v, width: F.when(width > 0, F.lpad(F.lower(F.conv(v.cast("string"), 10, base)), width, "0")).otherwise("")
    return F.aggregate(F.array(out), F.lit(""), lambda _, p: F.concat(text(p["l"], n - half), text(p["r"], half)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _fill(value: Column, new: Column, where: str) -> Column:
    """The value with its characters of class ``where`` replaced by those of ``new`` in turn."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def put(held: Column, char: Column) -> Column:
        hit = char.rlike(where)
        return F.struct(
            (held["at"] + hit.cast("int")).alias("at"),
            F.concat(held["out"], F.when(hit, F.substr(new, held["at"], F.lit(1))).otherwise(char)).alias("out"),
        )

    return F.aggregate(F.split(value, ""), start, put, lambda held: held["out"])


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Sum of the check-digit rule; every second digit from the right is doubled."""
    n = F.length(digits)

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(digits, n - at + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(at % 2 == (1 if doubled_last else 0), twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(value: Column, secret: str) -> Column:
    digits = _digits(value)
    first, middle = F.substr(digits, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2), F.length(digits) - 2)
    body = F.concat(first, permuted_numerals(middle, 10, secret, "card"))
    bound = lambda b: F.concat(b, F.pmod(10 - luhn_sum(b, True) % 10, F.lit(10)).cast("string"))
    new = F.aggregate(F.array(body), F.lit(""), lambda _, b: bound(b))
    return F.when(luhn_sum(digits, False) % 10 == 0, _fill(value, new, "[0-9]")).otherwise(value)


def _phone(value: Column, secret: str) -> Column:
    digits = F.right(_digits(value), F.lit(10))
    area, office, line = (F.substr(digits, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (4, 3), (7, 4)))
    number = ((area - 200) * 800 + (office - 200)) * 10_000 + line
    new = permuted_number(number, (80_000, 80_000), secret, "phone")
    written = lambda x: F.concat(
        F.when(F.length(_digits(value)) > 10, "1").otherwise(""),
        (F.floor(x / 8_000_000) + 200).cast("string"), (F.floor(x / 10_000) % 800 + 200).cast("string"),
        F.lpad((x % 10_000).cast("string"), 4, "0"),
    )
    filled = F.aggregate(F.array(new), F.lit(""), lambda _, x: _fill(value, written(x), "[0-9]"))
    return F.when((area >= 200) & (office >= 200), filled).otherwise(value)


def _abroad(value: Column, secret: str) -> Column:
    digits = _digits(value)
    new = F.concat(F.substr(digits, F.lit(1), F.lit(2)), permuted_numerals(F.substr(digits, F.lit(3), F.length(digits) - 2), 10, secret, "abroad"))
    return F.when(F.length(digits).between(8, 15), _fill(value, new, "[0-9]")).otherwise(value)


def _ssn(value: Column, secret: str) -> Column:
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    # areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999
    left = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
    new = permuted_number(left * 9_999 + serial - 1, (898 * 99, 9_999), secret, "ssn")

    def written(x: Column) -> Column:
        place = F.floor(x / (99 * 9_999))
        own = place + F.when(place >= 665, 2).otherwise(1)
        parts = ((own, 3), (F.floor(x / 9_999) % 99 + 1, 2), (x % 9_999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in parts])

    return F.when(valid, F.aggregate(F.array(new), F.lit(""), lambda _, x: written(x))).otherwise(value)


def _ipv4(value: Column, secret: str) -> Column:
    part = lambda i: F.split_part(value, F.lit("."), F.lit(i)).cast("long")
    valid = (part(1) < 256) & (part(2) < 256) & (part(3) < 256) & (part(4) < 256)
    out = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), (65_536, 65_536), secret, F.lit("ipv4"))
    octets = lambda p: F.concat_ws(".", *[x.cast("string") for h in (p["l"], p["r"]) for x in (F.floor(h / 256), h % 256)])
    return F.when(valid, F.aggregate(F.array(out), F.lit(""), lambda _, p: octets(p))).otherwise(value)


def _late_day(day: Column, secret: str) -> Column:
    """Digits MMddyyyy of the pseudonym of a date whose day of the month is 13 or more, another such date.

    Days 13 to 28, 29 and 30, 31, and leap days are each permuted among themselves, so every result
    is a date that reads in one way only.
    """
    year, month, dom = F.year(day) - 1900, F.month(day), F.dayofmonth(day)
    long_months = F.array(*[F.lit(m) for m in (1, 3, 5, 7, 8, 10, 12)])
    no_february = F.array(*[F.lit(m) for m in (1, *range(3, 13))])
    place = F.array_position(no_february, month) - 1

    def text(m: Column, d: Column, y: Column) -> Column:
        return F.concat(*[F.lpad(x.cast("int").cast("string"), n, "0") for x, n in ((m, 2), (d, 2), (y + 1900, 4))])

    def turned(number: Column, sizes: tuple[int, int], kind: str, write) -> Column:
        new = permuted_number(number.cast("long"), sizes, secret, kind)
        return F.aggregate(F.array(new), F.lit(""), lambda _, x: write(x))

    years = _LATE_YEARS
    usual = turned((year * 12 + month - 1) * 16 + dom - 13, (years * 12, 16), "late13", lambda x: text(F.floor(x / 16) % 12 + 1, x % 16 + 13, F.floor(x / 192)))
    end = turned((year * 11 + place) * 2 + dom - 29, (years * 11, 2), "late29", lambda x: text(F.element_at(no_february, (F.floor(x / 2) % 11 + 1).cast("int")), x % 2 + 29, F.floor(x / 22)))
    last = turned(year * 7 + F.array_position(long_months, month) - 1, (years, 7), "late31", lambda x: text(F.element_at(long_months, (x % 7 + 1).cast("int")), F.lit(31), F.floor(x / 7)))
    leap = turned(F.floor((year - 4) / 4), (7, 7), "leap", lambda x: text(F.lit(2), F.lit(29), x * 4 + 4))
    return F.when(dom <= 28, usual).when(month == 2, leap).when(dom == 31, last).otherwise(end)


def _date(value: Column, secret: str) -> Column:
    """Dates that read day first, or year first, are permuted as days; those that can only read month first among themselves."""
    iso = value.rlike("^[0-9]{4}")
    parts = F.regexp_replace(value, "[/.]", "-")
    first = F.lit("1900-01-01").cast("date")
    late = F.try_to_timestamp(parts, F.lit("MM-dd-yyyy")).cast("date")
    kept = ~iso & (F.dayofmonth(late) > 12) & F.year(late).between(1900, 1899 + _LATE_YEARS)
    out = F.when(kept, _fill(value, _late_day(late, secret), "[0-9]")).otherwise(value)
    for pattern, fits in (("dd-MM-yyyy", ~iso), ("yyyy-MM-dd", iso)):
        day = F.datediff(F.try_to_timestamp(parts, F.lit(pattern)).cast("date"), first)
        new = permuted_number(day.cast("long"), _DATE_RESIDUES, secret, "date")
        text = F.date_format(F.date_add(first, new.cast("int")), pattern)
        valid = fits & day.between(0, _DATE_RESIDUES[0] * _DATE_RESIDUES[1] - 1)
        out = F.when(valid, _fill(value, _digits(text), "[0-9]")).otherwise(out)
    return out


def _email(value: Column, secret: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    plain = F.lower(F.regexp_replace(local, "[^A-Za-z0-9]", ""))
    pieces = F.regexp_extract_all(plain, F.lit(".{1,20}"), F.lit(0))
    new = F.array_join(F.transform(pieces, lambda p: permuted_numerals(p, 36, secret, "email")), "")
    return F.concat(_fill(local, new, "[A-Za-z0-9]"), F.lit("@"), domain)


def pseudonym(value: Column, secret: str) -> Column:
    """The pseudonym of one found value, or the value itself if it isn't valid."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    return (
        F.when(whole(EMAIL), _email(value, secret))
        .when(whole(DATE), _date(value, secret))
        .when(whole(SSN), _ssn(value, secret))
        .when(whole(PHONE), _phone(value, secret))
        .when(whole(ABROAD), _abroad(value, secret))
        .when(whole(IPV4), _ipv4(value, secret))
        .when(whole(CARD), _card(value, secret))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, secret: str, text: str = "text", found: str = "_found", changed: str = "_changed") -> DataFrame:
    """The documents with pseudonyms in their text, and the values found and changed added."""
    held = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"))
    matches = F.when(F.col("_text").rlike("[0-9@]"), F.regexp_extract_all("_text", F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    matched = held.withColumn("_values", matches)
    named = matched.withColumn("_new", F.transform("_values", lambda v: pseudonym(v, secret)))
    gaps = F.split("_text", ANY, -1)
    joined = F.array_join(F.zip_with(gaps, F.concat(F.col("_new"), F.array(F.lit(""))), lambda g, n: F.concat(g, n)), "")
    new_text = F.when(F.size("_values") > 0, joined).otherwise(F.col("_text"))
    columns = [new_text.alias(c) if c == text else F.col("_doc")[c].alias(c) for c in docs.columns]
    differs = F.zip_with("_values", "_new", lambda a, b: (a != b).cast("int"))
    count = F.aggregate(differs, F.lit(0), lambda a, x: a + x)
    return named.select(*columns, F.col("_values").alias(found), count.cast("long").alias(changed))
