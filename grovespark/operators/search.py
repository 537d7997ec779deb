"""Search over units: exact filters, folded substrings, codes, keyset pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.hashing import encode_cursor
from ..sources.registry import CODE_SCHEME

VIEW = ("territory_id", "official_name", "normalized_name", "territory_type", "administrative_role", "level", "parent_id", "county_id", "status")


def matching(units: DataFrame, q: str | None = None, code: str | None = None, territory_id: str | None = None, type: str | None = None, status: str | None = None, county_id: str | None = None) -> DataFrame:
    """Units that pass all given filters; empty ones are no filters. Needs identifiers where a code is given."""
    for name, value in (("territory_id", territory_id), ("territory_type", type), ("status", status), ("county_id", county_id)):
        if value:
            units = units.where(F.col(name) == value)
    if code:
        units = units.where(F.exists("identifiers", lambda x: (x["scheme"] == CODE_SCHEME) & (x["value"] == code)))
    if q:
        folded = X.fold(F.lit(q))
        units = units.where(F.contains(X.fold(F.col("official_name")), folded) | F.contains(X.fold(F.col("normalized_name")), folded))
    return units


def routed(units: DataFrame, q: str) -> DataFrame:
    """A query of digits only is a code, any other a name."""
    return matching(units, code=q) if q.isdigit() else matching(units, q=q)


def page(found: DataFrame, limit: int = 50, after: str | None = None, key: str = "territory_id") -> DataFrame:
    """The next `limit` rows by key. after: the key of the last row before; one that is beyond all gives an empty page."""
    limit = min(limit, 200) if limit > 0 else 50
    rows = found.where(F.col(key) > after) if after else found
    return rows.orderBy(key).limit(limit)


def page_info(found: DataFrame, limit: int = 50, after: str | None = None, key: str = "territory_id") -> DataFrame:
    """One row (total, returned, next_cursor): total counts all that was found; the cursor is null on the last page."""
    limit = min(limit, 200) if limit > 0 else 50
    rest = found.where(F.col(key) > after) if after else found
    ahead = rest.select(key).orderBy(key).limit(limit + 1)
    last = ahead.orderBy(key).limit(limit).agg(F.max(key).alias("last"), F.count("*").alias("returned"))
    more = ahead.agg(F.count("*").alias("seen"))
    total = found.agg(F.count("*").alias("total"))
    return total.crossJoin(last).crossJoin(more).select("total", "returned", F.when(F.col("seen") > limit, encode_cursor(F.col("last"))).alias("next_cursor"))  # one row each


def view(units: DataFrame) -> DataFrame:
    return units.select(*VIEW)


def full_view(units: DataFrame) -> DataFrame:
    """The view with the short name and the identifiers, sorted by scheme and value. Needs identifiers."""
    listed = F.array_sort(F.transform("identifiers", lambda x: F.struct(x["scheme"].alias("scheme"), x["value"].alias("value"), x["status"].alias("status"))))
    return units.select(*VIEW, X.short_name(F.col("official_name")).alias("short_name"), listed.alias("identifiers"))


def detail(units: DataFrame, territory_id: str, most: int = 32) -> DataFrame:
    """Rows (relation, hop, ...view): the unit itself, its ancestors, nearest first by hop, and its children; empty if there is no such unit."""
    own = units.where(F.col("territory_id") == territory_id)
    out = [own.withColumns({"relation": F.lit("self"), "hop": F.lit(0)}), children(units, territory_id).withColumns({"relation": F.lit("child"), "hop": F.lit(1)})]
    at, seen = own, [territory_id]
    for hop in range(1, most + 1):
        up = at.select(F.col("parent_id").alias("territory_id")).first()  # one unit's parent
        if up is None or up[0] is None or up[0] in seen:
            break
        seen.append(up[0])
        at = units.where(F.col("territory_id") == up[0])
        out.append(at.withColumns({"relation": F.lit("ancestor"), "hop": F.lit(hop)}))
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part)
    view = full_view(found)
    return found.select("relation", "hop", "territory_id").join(view, "territory_id")


def children(units: DataFrame, parent_id: str) -> DataFrame:
    return units.where(F.col("parent_id") == parent_id)


def roots(units: DataFrame) -> DataFrame:
    return units.where(F.col("parent_id").isNull())


def named_order(units: DataFrame) -> DataFrame:
    """By name as Romanian sorts it."""
    return units.orderBy(F.collate("official_name", "RO"), "territory_id")
