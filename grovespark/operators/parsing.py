"""Sheet rows to typed records. Rows that do not parse stay, with their error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X

# The columns of the source sheet in order, as normalized headers.
HEADERS = ("SIRUTA", "DENLOC", "CODP", "JUD", "SIRSUP", "TIP", "NIV", "MED", "REGIUNE", "FSJ", "FSL", "NUTS")


def header_matches(cells: Column, headers: tuple[str, ...] = HEADERS) -> Column:
    """Whether a row of cells is the expected header. Headers are plain ASCII here once normalized."""
    got = F.transform(cells, lambda c: F.upper(X.collapse(F.regexp_replace(F.coalesce(c, F.lit("")), r"^\x{FEFF}", ""))))
    return F.slice(got, 1, len(headers)) == F.array(*map(F.lit, headers))


def record_hash(cells: Column) -> Column:
    return F.sha2(F.to_json(F.transform(cells, lambda c: F.coalesce(c, F.lit("")))), 256)


def parse_rows(sheet: DataFrame, headers: tuple[str, ...] = HEADERS) -> DataFrame:
    """Rows (row_number, record_key, record_hash, raw, extra_cells, record, error, parse_status) of a sheet (row_number, cells) without its header. Empty rows go."""
    rows = sheet.where(~F.forall("cells", lambda c: c.isNull() | (F.trim(c) == "")))
    cell = {h: F.get("cells", i) for i, h in enumerate(headers)}
    fields = {
        "code": N.source_integer(cell["SIRUTA"], "SIRUTA", most=999_999),
        "postal": N.source_integer(cell["CODP"], "CODP", allow_zero=True, most=999_999),
        "county": N.source_integer(cell["JUD"], "JUD", least=1, most=99),
        "parent": N.source_integer(cell["SIRSUP"], "SIRSUP", allow_zero=True, most=999_999),
        "type": N.source_integer(cell["TIP"], "TIP", least=1, most=99),
        "environment": N.source_integer(cell["MED"], "MED", allow_zero=True, most=9),
        "region": N.source_integer(cell["REGIUNE"], "REGIUNE", allow_zero=True, most=9),
        "order": N.source_integer(cell["FSJ"], "FSJ", allow_zero=True, most=99),
    }
    name, level, fsl = X.optional_text(cell["DENLOC"]), N.level(cell["NIV"]), F.trim(cell["FSL"])
    nuts = F.upper(X.optional_text(cell["NUTS"]))
    errors = [v["error"] for v in fields.values()] + [F.when(name.isNull(), "DENLOC is required"), F.when(level.isNull(), "NIV must be a level"), F.when(~F.coalesce(fsl.rlike(r"^\d{13}$"), F.lit(False)), "FSL must be 13 digits")]
    record = F.struct(
        *(fields[k]["value"].cast("int" if k in ("type", "environment", "region", "order") else "string").alias(k) for k in fields),
        name.alias("name"), level.alias("level"), fsl.alias("fsl"), nuts.alias("nuts"),
    )
    extra = F.exists(F.slice("cells", len(headers) + 1, F.greatest(F.size("cells") - len(headers), F.lit(0))), lambda c: c.isNotNull() & (F.trim(c) != ""))
    out = rows.select("row_number", F.concat(F.lit("row:"), "row_number").alias("record_key"), record_hash(F.col("cells")).alias("record_hash"), F.map_from_arrays(F.array(*map(F.lit, headers)), F.slice(F.concat("cells", F.array_repeat(F.lit(None).cast("string"), len(headers))), 1, len(headers))).alias("raw"), extra.alias("extra_cells"), F.coalesce(*errors).alias("error"), record.alias("record"))
    return out.withColumn("record", F.when(F.col("error").isNull(), F.col("record"))).withColumn("parse_status", F.when(F.col("error").isNull(), "parsed").otherwise("invalid"))
