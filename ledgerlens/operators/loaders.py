"""Feed loaders: staging (rename + typed cast), JSON payloads, replace-slice
and upsert by id.

Without a table format there is no MERGE on parquet; an upsert is one
full-outer join on the key producing the next snapshot, to be written to a
new path; readers switch to it only after it is complete.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# feed column -> (target column, type)
APPS_MAPPING = [
    ("ID", "id", "bigint"), ("lenderID", "lender_id", "smallint"),
    ("branchNumber", "facility_code", "string"), ("branchName", "upload_legal_name", "string"),
    ("Accepts", "accept", "int"), ("AcceptsVal", "accept_val", "decimal(10,0)"),
    ("Declines", "decline", "int"), ("DeclinesVal", "decline_val", "decimal(10,0)"),
    ("Pending", "pending", "int"), ("PendingVal", "pending_val", "decimal(10,0)"),
    ("month", "month", "int"), ("year", "year", "int"),
    ("importDate", "upload_date", "timestamp_ntz"),
]
PAIDS_MAPPING = [
    ("PK", "id", "bigint"), ("lenderID", "lender_id", "smallint"),
    ("branchNumber", "facility_code", "string"), ("branchName", "upload_legal_name", "string"),
    ("product", "product_code", "string"), ("defer", "defer_by", "int"),
    ("rate", "apr", "decimal(18,10)"), ("term", "term", "int"),
    ("advance", "advance", "decimal(10,0)"), ("decDate", "date", "timestamp_ntz"),
    ("commPercent", "return_rate", "decimal(10,4)"),
    ("month", "month", "int"), ("year", "year", "int"),
    ("importDate", "upload_date", "timestamp_ntz"),
]
# columns compared to detect a changed row (the applications loader does
# not compare upload_date; the paid loader does)
APPS_CHANGE_COLS = ["lender_id", "facility_code", "upload_legal_name", "accept", "accept_val",
                    "decline", "decline_val", "pending", "pending_val", "month", "year"]
PAIDS_CHANGE_COLS = ["lender_id", "facility_code", "upload_legal_name", "product_code", "defer_by",
                     "apr", "term", "advance", "date", "return_rate", "month", "year", "upload_date"]


def stage(feed: DataFrame, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Rename and cast feed columns (ANSI: a bad value raises)."""
    return feed.select(*[F.col(src).cast(typ).alias(dst) for src, dst, typ in mapping])


def with_upload_month(df: DataFrame) -> DataFrame:
    """applications: ``year_month`` = first 7 chars of the ISO upload date."""
    return df.withColumn("year_month", F.date_format("upload_date", "yyyy-MM"))


def with_business_month(df: DataFrame) -> DataFrame:
    """paid deals: ``year_month`` = ``year + '-' + right('0' + month, 2)``."""
    return df.withColumn("year_month", F.concat(F.col("year").cast("string"), F.lit("-"),
                                                F.lpad(F.col("month").cast("string"), 2, "0")))


def stage_applications(apps: DataFrame) -> DataFrame:
    return with_upload_month(stage(apps, APPS_MAPPING))


def stage_paids(tb_paids: DataFrame) -> DataFrame:
    return with_business_month(stage(tb_paids, PAIDS_MAPPING))


def changed(cols: list[str], null_safe: bool = False, t: str = "t", s: str = "s") -> Column:
    """Any listed column differs. With ``<>`` semantics (default) a
    NULL on either side is *not* a change."""
    if null_safe:
        parts = [~F.col(f"{t}.{c}").eqNullSafe(F.col(f"{s}.{c}")) for c in cols]
    else:
        parts = [F.coalesce(F.col(f"{t}.{c}") != F.col(f"{s}.{c}"), F.lit(False)) for c in cols]
    return reduce(lambda a, b: a | b, parts)


def upsert_changed(target: DataFrame, staged: DataFrame, key: str, cols: list[str],
                   null_safe: bool = False) -> DataFrame:
    """Staged rows whose key exists in the target with a changed column."""
    j = staged.alias("s").join(target.alias("t"), key)
    return j.filter(changed(cols, null_safe)).select(*[F.col(f"s.{c}").alias(c) if c != key else F.col(key)
                                                       for c in staged.columns])


def upsert_new(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Staged rows whose key is absent from the target (NOT EXISTS)."""
    return staged.join(target.select(key), key, "left_anti")


def one_per_key(staged: DataFrame, key: str, latest: list[str] | None = None) -> DataFrame:
    """Staged rows with one row per key. With ``latest``, that of the greatest
    such columns stays (a redelivered row); without, a repeated key raises.
    The window needs the partitioning and order that the join by key needs, so
    it adds no shuffle."""
    w = Window.partitionBy(key)
    if latest is not None:
        order = [F.col(c).desc_nulls_last() for c in latest]
        return staged.withColumn("_n", F.row_number().over(w.orderBy(*order))).filter("_n = 1").drop("_n")
    n = F.count(F.lit(1)).over(w)
    guard = F.when(n > 1, F.raise_error(F.concat(F.lit(f"staged rows repeat {key} "), F.col(key).cast("string"))).cast("boolean"))
    return staged.withColumn("_ok", F.coalesce(guard, F.lit(True))).filter("_ok").drop("_ok")


def upsert(target: DataFrame, staged: DataFrame, key: str, cols: list[str],
           null_safe: bool = False, latest: list[str] | None = None) -> DataFrame:
    """Next snapshot: changed rows take the staged values, unchanged and
    target-only rows keep theirs, new keys are inserted. One full outer
    join on the key, plus a ``_op`` column (updated/inserted/kept). Staged
    rows that repeat a key: see ``one_per_key``."""
    t, s = target.alias("t"), one_per_key(staged, key, latest).alias("s")
    j = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_t, in_s = F.col(f"t.{key}").isNotNull(), F.col(f"s.{key}").isNotNull()
    upd = in_t & in_s & changed(cols, null_safe)
    take_s = upd | ~in_t
    out = [F.when(take_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    op = F.when(~in_t, F.lit("inserted")).when(upd, F.lit("updated")).otherwise(F.lit("kept"))
    return j.select(*out, op.alias("_op"))


def upsert_counts(merged: DataFrame, table: str) -> DataFrame:
    """Affected-row counts of an upsert (one row)."""
    return merged.agg(
        F.lit(table).alias("table_name"),
        F.count(F.when(F.col("_op") == "updated", 1)).cast("bigint").alias("rows_updated"),
        F.count(F.when(F.col("_op") == "inserted", 1)).cast("bigint").alias("rows_inserted"),
        F.count(F.lit(1)).cast("bigint").alias("rows_total"))


# --------------------------------------------------------------------------
# JSON payloads of the older month loader
# --------------------------------------------------------------------------

JSON_ELEMENT = ("array<struct<date:string,branch_id:string,branch_upload_name:string,lender_id:string,"
                "app:string,accept:string,pending:string,decline:string,advance:string>>")
JSON_TYPES = [("date", "date"), ("branch_id", "string"), ("branch_upload_name", "string"),
              ("lender_id", "int"), ("app", "int"), ("accept", "int"), ("pending", "int"),
              ("decline", "int"), ("advance", "decimal(9,2)")]


BAD_HEADER = "Invalid JSON format: Date or Lender ID is missing or incorrect."


def _elements(docs: DataFrame, col: str) -> DataFrame:
    """Payloads as arrays; raises if a payload's first element has no date or lender."""
    parsed = docs.select(F.from_json(F.col(col), JSON_ELEMENT).alias("es"))
    first = F.get("es", F.lit(0))
    ok = first.getField("date").cast("date").isNotNull() & first.getField("lender_id").cast("int").isNotNull()
    return parsed.select(F.when(F.coalesce(ok, F.lit(False)), F.col("es")).otherwise(F.raise_error(F.lit(BAD_HEADER))).alias("es"))


def json_rows(docs: DataFrame, col: str = "payload") -> DataFrame:
    """Explode JSON array payloads into typed rows (missing field -> NULL,
    bad value or bad header -> error)."""
    e = _elements(docs, col).select(F.explode("es").alias("e"))
    return e.select(*[F.col(f"e.{k}").cast(t).alias(k) for k, t in JSON_TYPES])


def json_header(docs: DataFrame, col: str = "payload") -> DataFrame:
    """First element's (date, lender_id) per payload; raises if either is NULL."""
    first = F.get("es", F.lit(0))
    return _elements(docs, col).select(first.getField("date").cast("date").alias("date"),
                                       first.getField("lender_id").cast("int").alias("lender_id"))


def replace_slice(target: DataFrame, payload: DataFrame, keys: list[str], named: DataFrame | None = None) -> DataFrame:
    """Delete target rows whose keys appear in the payload (or only those
    that ``named`` lists, as ``json_header`` gives them), then insert the
    payload (a key set, not the rows, is shuffled against the target)."""
    k = (payload if named is None else named).select(*keys).distinct()
    return target.join(k, keys, "left_anti").unionByName(payload)
