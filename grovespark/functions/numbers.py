"""Numbers, codes, versions and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The weights of a code's digits, from the second last on; the page sizes.
CHECK_WEIGHTS = (1, 2, 3, 5, 7)
PAGE, MOST_PAGE = 50, 200
SAFE = 2**53 - 1


def source_integer(value: Column, field: str, optional: bool = False, allow_zero: bool = False, least: int | None = None, most: int | None = None) -> Column:
    """A struct (value, error); one of them is null, or both for an optional empty cell."""
    text = F.trim(value.cast("string"))
    empty = text.isNull() | (text == "")
    digits = F.regexp_extract(text, r"^(\d+)(\.0+)?$", 1)
    number = F.when(F.length(F.regexp_replace(digits, "^0+", "")) <= 16, digits.try_cast("bigint"))
    error = (
        F.when(empty, F.lit(None if optional else f"{field} is required"))
        .when(digits == "", f"{field} must be an integer")
        .when(number.isNull() | (number > SAFE), f"{field} is outside the safe integer range")
    )
    if not allow_zero:
        error = error.when(number == 0, f"{field} must be greater than zero")
    if least is not None:
        error = error.when(number < least, f"{field} must be at least {least}")
    if most is not None:
        error = error.when(number > most, f"{field} must be at most {most}")
    return F.struct(F.when(error.isNull() & ~empty, number).alias("value"), error.alias("error"))


def level(value: Column) -> Column:
    """A level 1 to 3, from a number or a text such as 'NIVEL 2'; null if it is none."""
    text = F.trim(value.cast("string"))
    n = F.coalesce(F.nullif(F.regexp_extract(text, r"(?i)^NIVEL\s*([1-3])$", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"^0*([1-3])(?:\.0+)?$", 1), F.lit("")))
    return n.cast("int")


def checksum_valid(code: Column) -> Column:
    """Whether the last digit is the check digit of those before it. Null and values outside 0..999999: false."""
    n = code.try_cast("bigint")
    total = F.lit(0)
    for i, weight in enumerate(CHECK_WEIGHTS, 1):
        product = F.floor(n / 10**i) % 10 * weight
        total = total + F.floor(product / 10) + product % 10
    return F.coalesce((n >= 0) & (n < 1_000_000) & ((11 - total % 10) % 10 == n % 10), F.lit(False))


def clamp_limit(value: Column) -> Column:
    """The whole number that a text begins with, at most MOST_PAGE; PAGE if there is none above 0."""
    found = F.regexp_extract(F.coalesce(value.cast("string"), F.lit("")), r"^\s*\+?(\d+)", 1)
    n = F.when(F.length(found) > 9, F.lit(MOST_PAGE)).otherwise(found.try_cast("int"))
    return F.when(n > 0, F.least(n, F.lit(MOST_PAGE))).otherwise(F.lit(PAGE))


def semver_major(version: Column) -> Column:
    return F.regexp_extract(version, r"^(\d+)\.\d+\.\d+$", 1).try_cast("int")


def release_date(release_id: Column) -> Column:
    """The date of an id YYYY.MM.DD.N; null if it is not such an id."""
    return F.when(release_id.rlike(r"^\d{4}\.\d{2}\.\d{2}\.[1-9]\d*$"), F.try_to_date(F.replace(F.substring(release_id, 1, 10), F.lit("."), F.lit("-")), "yyyy-MM-dd"))


def utc_milliseconds(value: Column) -> Column:
    """Whether a text is an exact UTC time with milliseconds."""
    shown = F.date_format(F.try_to_timestamp(value), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return F.coalesce(value.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$") & (shown == value), F.lit(False))


def iso_time(value: Column) -> Column:
    return F.date_format(value.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def backoff_ms(attempt: Column, retry_after_s: Column | None = None) -> Column:
    """Doubling from 500 ms to 8 s; what the server asked for instead, at most 30 s."""
    own = F.least(500 * F.pow(F.lit(2), attempt - 1), F.lit(8000)).cast("long")
    return own if retry_after_s is None else F.when(retry_after_s.isNotNull(), F.least(retry_after_s * 1000, F.lit(30_000)).cast("long")).otherwise(own)


def uuid7(millis: Column, seed: Column) -> Column:
    """A version 7 UUID of a time and of a seed that must differ between rows."""
    noise = F.sha2(seed.cast("string"), 256)
    variant = F.element_at(F.array(*map(F.lit, "89ab")), (F.conv(F.substring(noise, 4, 1), 16, 10).cast("int") % 4) + 1)
    head = F.lpad(F.lower(F.hex(millis)), 12, "0")
    return F.concat(F.substring(head, 1, 8), F.lit("-"), F.substring(head, 9, 4), F.lit("-7"), F.substring(noise, 1, 3), F.lit("-"), variant, F.substring(noise, 5, 3), F.lit("-"), F.substring(noise, 8, 12))


UUID7 = "^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
SHA256 = "^[0-9a-f]{64}$"
COMMIT = "^[0-9a-f]{40}$"
SEMVER = r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)$"
