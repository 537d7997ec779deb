"""Benchmark decontamination by size-partitioned MinHash containment search, with DataFrame functions only.

Items are partitioned by size (distinct shingles, in classes of powers of
1.25). An item's sketch is its least-hashed shingles, and how many those are
depends on its class: with at least `share` of n shingles in a document, at
most n - ceil(share * n) can be missing, so one shingle more than that (for
the largest n of the class) always hits. A sketch of a long document would
lose a short item, so documents are not sketched: their shingles probe the
index of item sketches. Pairs that meet are verified on the shingles
themselves.

The index goes to all workers if it has at most `broadcast_rows` rows (it is
counted), else both sides are shuffled; likewise the pairs to verify and the
items, whose bytes are counted too. Documents are known by id and a hash of id
and text.

Words are runs of letters and digits in lower case. Shingles are SHINGLE words;
a text of fewer words is one shingle, and is looked for at its own length.

Defined cases: null texts and texts without words have no shingles and match
nothing; a null id stays null; repeated rows give repeated pairs for documents
and one pair for items; rows of items without id are dropped; empty tables
give an empty result; other columns are ignored; texts of any length are
searched whole; shingles of equal hash are told apart by the verification.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_ROWS, cut, small

SHINGLE = 5


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _windows(items: Column, size: int, make) -> Column:
    n = F.size(items) - size + 1
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), make))


def shingles(items: Column, size: int) -> Column:
    """All runs of `size` words as text; null if there are fewer words."""
    return _windows(items, size, lambda i: F.array_join(F.slice(items, i, size), " "))


def shingle_hashes(hashes: Column, size: int) -> Column:
    """A hash of each run of `size` words from the words' hashes; of other sizes other hashes."""
    return _windows(hashes, size, lambda i: F.xxhash64(F.lit(size), *(F.get(hashes, i + (k - 1)) for k in range(size))))


def item_sketches(benchmark: DataFrame, share: float, id_col: str, text_col: str) -> DataFrame:
    """Rows (item, width, shingles, sketch): the sketch holds hashes of width-word shingles."""
    own = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0).dropDuplicates(["item", "w"])
    width = F.least(F.size("w"), F.lit(SHINGLE))
    hashed = F.transform("w", lambda x: F.xxhash64(x))
    sized = F.array([F.lit(None)] + [F.when(F.size("w") >= k, F.array_distinct(shingle_hashes(hashed, k))) for k in range(1, SHINGLE + 1)])
    texts = F.array([F.lit(None)] + [F.when(F.size("w") >= k, F.array_distinct(shingles(F.col("w"), k))) for k in range(1, SHINGLE + 1)])
    own = own.select("item", width.alias("width"), F.get(texts, width).alias("shingles"), F.get(sized, width).alias("hashes"))
    n = F.size("hashes")
    most = F.greatest(n, F.floor(F.pow(F.lit(1.25), F.floor(F.log(n) / F.log(F.lit(1.25))) + 1)))  # of the size class
    need = F.ceil(most * share - 1e-9)
    return own.select("item", "width", "shingles", F.slice(F.array_sort("hashes"), F.lit(1), F.least(n, (most - need + 1).cast("int"))).alias("sketch"))


def row_key(id_col: str, text_col: str) -> Column:
    """What a document is known by, whether or not its id is null or repeated."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _met(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """rows joined with keys on (_id, _key); null ids are equal."""
    r, k = rows.alias("r"), keys.withColumnsRenamed({"_id": "_id_k", "_key": "_key_k"})
    out = r.join(k, (F.col("r._key") == F.col("_key_k")) & F.col("r._id").eqNullSafe(F.col("_id_k")), how)
    return out.drop("_id_k", "_key_k")


def contained(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows (id, item, n_shingles, n_shared, row_key): documents that hold at least `share` of an item's shingles."""
    items = cut(item_sketches(benchmark, share, item_col, item_text_col))
    index = items.select("item", F.explode("sketch").alias("h")).distinct()
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [SHINGLE]  # SHINGLE values at most

    rows = docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).alias("_text"))
    hashed = rows.select("_id", "_key", F.transform(words(F.col("_text")), lambda x: F.xxhash64(x)).alias("hs"))
    own = [shingle_hashes(F.col("hs"), k) for k in widths]
    none = F.array().cast("array<bigint>")
    probes = hashed.select("_id", "_key", F.explode(own[0] if len(own) == 1 else F.concat(*(F.coalesce(x, none) for x in own))).alias("h"))
    pairs = cut(probes.join(small(index, broadcast_rows), "h").select("_id", "_key", "item").distinct())

    by_width = F.map_from_arrays(F.array(*(F.lit(k) for k in widths)), F.array(*(F.coalesce(shingles(F.col("w"), k), F.array().cast("array<string>")) for k in widths)))
    asked = _met(rows, small(pairs.select("_id", "_key").distinct(), broadcast_rows), "left_semi").select("_id", "_key", words(F.col("_text")).alias("w"))
    whole = items.select("item", "width", "shingles")
    met = _met(asked.select("_id", "_key", by_width.alias("own")), small(pairs, broadcast_rows), "inner").join(small(whole, broadcast_rows, F.octet_length(F.array_join("shingles", ""))), "item")
    return (
        met.select(F.col("_id").alias(id_col), F.col("item").alias(item_col), F.size("shingles").cast("long").alias("n_shingles"), F.size(F.array_intersect("shingles", F.get(F.map_values("own"), F.array_position(F.map_keys("own"), F.col("width")).cast("int") - 1))).cast("long").alias("n_shared"), F.col("_key").alias("row_key"))
        .where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * share - 1e-9))
    )
