"""Text functions. All but nfkc and match_name stay inside Spark's code generation.

A null argument gives null unless a function says otherwise.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that searches fold, cedilla letters and their comma-below forms, administrative prefixes,
# patterns of credentials in messages.
FOLDED, FOLDED_TO = "ăâîșțşţ", "aaistst"
CEDILLA, COMMA_BELOW = "ŞşŢţ", "ȘșȚț"
PREFIXES = ("JUDEȚUL", "JUDEŢUL", "MUNICIPIUL", "ORAȘUL", "ORAŞUL", "ORAȘ", "ORAŞ", "COMUNA", "SECTORUL")
CREDENTIALS = (r"(?i)postgres(?:ql)?://\S+", r"sb_(?:secret|publishable)_[A-Za-z0-9._-]+", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
MESSAGE_LENGTH = 500

_PREFIX = "(?iU)^(?:" + "|".join(PREFIXES) + r")\s+"


def fold(text: Column) -> Column:
    """Lower case without the folded letters' marks; null counts as empty."""
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), FOLDED, FOLDED_TO)


def collapse(text: Column) -> Column:
    """Outer white space goes, inner runs become one space; white space as Unicode has it."""
    inner = F.regexp_replace(text, r"(?U)[\s\x{FEFF}]+", " ")
    return F.regexp_replace(inner, "^ | $", "")


def _form(name: str):
    @F.pandas_udf("string")
    def normalize(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize(name, x), na_action="ignore")

    return normalize


def _normal(text: Column, form: str) -> Column:
    """Only texts beyond ASCII change in normalization."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), text).otherwise(_form(form)(text))


def nfkc(text: Column) -> Column:
    return _normal(text, "NFKC")


def normalize_text(text: Column) -> Column:
    """Compatibility form, comma-below letters, collapsed white space; null counts as empty."""
    return collapse(F.translate(nfkc(F.coalesce(text, F.lit(""))), CEDILLA, COMMA_BELOW))


def normalize_header(text: Column) -> Column:
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\x{FEFF}", "")
    return F.upper(collapse(nfkc(plain)))


def optional_text(text: Column) -> Column:
    return F.when(text.isNotNull(), F.nullif(normalize_text(text), F.lit("")))


def search_name(text: Column) -> Column:
    return F.lower(normalize_text(text))


def short_name(text: Column) -> Column:
    """Without one administrative prefix; the whole name if nothing is left."""
    whole = normalize_text(text)
    return F.coalesce(F.nullif(collapse(F.regexp_replace(whole, _PREFIX, "")), F.lit("")), whole)


def slugify(text: Column, fallback: str = "unit") -> Column:
    """fallback: what a name without letters or digits becomes."""
    joined = F.regexp_replace(fold(text), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(joined, "^-+|-+$", ""), F.lit("")), F.lit(fallback))


def match_name(text: Column) -> Column:
    """For matching by name: prefix dropped (of sectors shortened), marks dropped, upper case."""
    plain = collapse(F.coalesce(text, F.lit("")))
    sector = F.regexp_replace(plain, r"(?iU)^SECTORUL\s+", "SECTOR ")
    bare = F.when(sector != plain, sector).otherwise(F.regexp_replace(plain, _PREFIX, ""))
    return F.upper(F.regexp_replace(_normal(bare, "NFD"), r"[\x{0300}-\x{036F}]", ""))


def code_candidates(text: Column) -> Column:
    """The trimmed text, and every run of digits as it is and as a number, each once, in order."""
    raw = collapse(F.coalesce(text.cast("string"), F.lit("")))
    runs = F.regexp_extract_all(raw, F.lit(r"(\d+)"))
    both = F.flatten(F.transform(runs, lambda x: F.array(x, F.regexp_replace(x, "^0+(?=.)", ""))))
    return F.when(raw == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(F.array(raw), both)))


def redact(message: Column) -> Column:
    for pattern in CREDENTIALS:
        message = F.regexp_replace(message, pattern, "[redacted]")
    return F.substring(message, 1, MESSAGE_LENGTH)


def media_type_header(value: Column) -> Column:
    return F.nullif(F.lower(F.trim(F.substring_index(value, ";", 1))), F.lit(""))


def csv_cell(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.coalesce(value.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def csv_line(*values: Column) -> Column:
    return F.concat_ws(",", *map(csv_cell, values))


def query_string(parameters: Column) -> Column:
    """name=value pairs of a map, without empty values, by name."""
    kept = F.array_sort(F.map_entries(F.map_filter(parameters, lambda k, v: v.isNotNull() & (v != ""))))
    return F.array_join(F.transform(kept, lambda x: F.concat(F.url_encode(x["key"]), F.lit("="), F.url_encode(x["value"]))), "&")


def client_key(forwarded: Column, real_ip: Column, hops: int = 1) -> Column:
    """The address that the outermost trusted proxy saw."""
    if hops <= 0:
        return F.lit("unknown")
    chain = F.filter(F.transform(F.split(forwarded, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(F.when(F.size(chain) >= hops, F.get(chain, F.size(chain) - hops)), real_ip, F.lit("unknown"))


def display_label(value: Column, labels: dict[str, str]) -> Column:
    known = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return F.coalesce(F.get(F.array(F.try_element_at(known, value)), F.lit(0)), value)
