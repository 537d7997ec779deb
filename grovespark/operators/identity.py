"""Identity reconciliation: which unit each source code stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import uuid7


def identity_index(identifiers: DataFrame, proposals: DataFrame) -> DataFrame:
    """Rows (code, territory_id, status, valid_to, origin): known identifiers, and distinct proposals of earlier runs."""
    known = identifiers.select("code", "territory_id", "status", "valid_to", F.lit("identifier").alias("origin"))
    asked = proposals.select("code", "territory_id", "status", F.lit(None).cast("date").alias("valid_to"), F.lit("proposal").alias("origin")).dropDuplicates(["code", "territory_id"])
    return known.unionByName(asked)


def reconcile(codes: DataFrame, index: DataFrame, now_ms: int = 0) -> DataFrame:
    """Rows (code, decision, territory_id, rule) for distinct codes; the first case that holds decides.

    codes: (code). A new unit's id is made of now_ms and the code.
    """
    proposal = F.col("origin") == "proposal"
    active = ~proposal & (F.col("status") == "active") & F.col("valid_to").isNull()
    open_ = proposal & (F.col("status") != "rejected")
    past = ~proposal & ~active
    seen = index.groupBy("code").agg(
        F.count_if(active).alias("actives"),
        F.count_if(open_).alias("proposals"),
        F.count_if(past).alias("pasts"),
        F.min(F.when(active, F.col("territory_id"))).alias("active_id"),
        F.min(F.when(open_, F.col("territory_id"))).alias("least_proposed"),
        F.max(F.when(open_, F.col("territory_id"))).alias("proposed_id"),
    )
    j = codes.select("code").distinct().join(seen, "code", "left")
    one = F.col("actives") == 1
    other = one & F.col("proposals").isNotNull() & ((F.col("least_proposed") != F.col("active_id")) | (F.col("proposed_id") != F.col("active_id")))
    cases = [
        (F.coalesce(other, F.lit(False)), "needs_review", None, "IDENTITY_ACTIVE_PROPOSAL_CONFLICT"),
        (one, "matched", F.col("active_id"), None),
        (F.col("actives") > 1, "needs_review", None, "IDENTITY_AMBIGUOUS_ACTIVE"),
        ((F.col("proposals") == 1) & (F.col("pasts") == 0), "create", F.col("proposed_id"), None),
        ((F.col("proposals") >= 1) & (F.col("pasts") >= 1), "needs_review", None, "IDENTITY_PROPOSAL_HISTORICAL_CONFLICT"),
        (F.col("proposals") > 1, "needs_review", None, "IDENTITY_AMBIGUOUS_PROPOSAL"),
        (F.col("actives").isNotNull(), "needs_review", None, "IDENTITY_HISTORICAL_REUSE_REVIEW"),
        (F.lit(True), "create", uuid7(F.lit(now_ms).cast("long"), F.col("code")), None),
    ]
    none = F.lit(None).cast("string")
    decision = unit = rule = F
    for holds, d, u, r in cases:
        decision, unit, rule = decision.when(holds, d), unit.when(holds, none if u is None else u), rule.when(holds, none if r is None else F.lit(r))
    return j.select("code", decision.alias("decision"), unit.alias("territory_id"), rule.alias("rule"))


def merged_ledger(ledger: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows (code, territory_id), later decisions over earlier ones."""
    new = decisions.where(F.col("territory_id").isNotNull()).select("code", F.col("territory_id").alias("_new"))
    return ledger.join(new, "code", "full_outer").select("code", F.coalesce("_new", "territory_id").alias("territory_id"))


def ambiguous_bindings(proposals: DataFrame) -> DataFrame:
    """Codes bound to several ids, and ids bound to several codes."""
    by_code = proposals.groupBy("code").agg(F.count_distinct("territory_id").alias("n")).where("n > 1").select(F.lit("code").alias("side"), F.col("code").alias("key"), "n")
    by_id = proposals.groupBy("territory_id").agg(F.count_distinct("code").alias("n")).where("n > 1").select(F.lit("territory_id").alias("side"), F.col("territory_id").alias("key"), "n")
    return by_code.unionByName(by_id)
