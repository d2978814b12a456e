"""Lender conversion report: applications vs paid deals per lender x month.

For every (lender, facility) pair of the scope and every requested month:
decline / accept / value / pending sums, proposed (= accept + decline) with a
"n (+k Ref)" text, accept rate text, paid total / count and conversion
(paid deals per proposal, %).

Defaults versus the literal reference (``compat=True``):

* applications are summed over the facility codes (the reference first takes
  DISTINCT value tuples, which merges codes with identical numbers);
* paid totals sum the advance of each distinct (deal id, advance) (the
  reference's ``SUM(DISTINCT advance)`` merges different deals of equal value).

The month set is a parameter list; the (lender, facility) x month spine is
produced by exploding that list on the lender rows (no cross join). Paid deals
reach lenders through the facility-code -> (lender, facility) map, which
replaces the reference's EXISTS inside a LEFT JOIN ON clause.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.filters import zero_if_null
from ledgerlens.functions.measures import money_text


def _months_array(months: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(int(m[:4])).alias("year"), F.lit(int(m[5:7])).alias("month"))
                     for m in months])


def _rounded_pct(num, den) -> Column:
    """``ROUND(CAST(num AS FLOAT) / CAST(den AS FLOAT) * 100, 0)``."""
    return F.round(F.col(num).cast("double") / F.col(den).cast("double") * 100, 0)


def lender_conversion(account: DataFrame, application_mth: DataFrame, paid_mth: DataFrame,
                      months: list[str], facility: str | None = None,
                      compat: bool = False) -> DataFrame:
    acc = account
    if facility is not None:
        acc = acc.filter(F.col("facility_used_by_id") == facility)
    lenders = acc.select("facility_lender", "facility_used_by_id").distinct()
    mset = [(int(m[:4]), int(m[5:7])) for m in months]
    cond = None
    for y, m in mset:
        c = (F.col("year") == y) & (F.col("month") == m)
        cond = c if cond is None else cond | c

    # --- applications: summed through the code map, then put on the place x month spine
    places = ["facility_lender", "facility_used_by_id", "legal_name", "trading_style", "is_reporting"]
    codes = acc.select("facility_code", *places).distinct()
    apps = application_mth.filter(cond).select("facility_code", "year", "month", "decline", "accept",
                                               "accept_val", "pending")
    d = apps.join(codes, "facility_code").drop("facility_code")
    if compat:
        d = d.distinct()
    d = d.groupBy(*places, "year", "month").agg(*(F.sum(c).alias(c) for c in ("decline", "accept", "accept_val", "pending")))
    place_months = acc.select(*places).distinct().select("*", F.explode(_months_array(months)).alias("m")) \
        .select(*places, "m.year", "m.month")
    s = place_months.join(d, [*places, "year", "month"], "left").select(
        *places, "year", "month",
        zero_if_null("decline").cast("bigint").alias("decline"), zero_if_null("accept").cast("bigint").alias("accept"),
        zero_if_null("accept_val").cast("decimal(18,2)").alias("accept_val"), zero_if_null("pending").cast("bigint").alias("pending"))
    s = s.withColumn("proposed", F.col("accept") + F.col("decline"))
    a = s.select(
        "facility_lender", F.format_string("%04d-%02d", "year", "month").alias("year_month"),
        "legal_name", "trading_style", "facility_used_by_id", "is_reporting",
        "decline", "accept", "accept_val", "pending", "proposed",
        F.concat(F.col("proposed").cast("string"),
                 F.when(F.col("pending") > 0, F.concat(F.lit(" (+"), F.col("pending").cast("string"), F.lit(" Ref)")))
                  .otherwise(F.lit(""))).alias("proposed_text"),
        F.when(F.col("proposed") == 0, F.lit("N/A"))
         .otherwise(F.concat(_rounded_pct("accept", "proposed").cast("bigint").cast("string"), F.lit("%")))
         .alias("accept_rate"),
        money_text("accept_val").alias("accept_val_text"))

    # --- paid deals through the facility-code -> (lender, facility) map
    cmap = acc.select("facility_code", "facility_lender", "facility_used_by_id").distinct()
    p = paid_mth.filter(cond).select("facility_code", "year", "month", "id", "advance")
    pj = p.join(cmap, "facility_code")
    pk = ["facility_lender", "facility_used_by_id", "year", "month"]
    if compat:
        pg = pj.groupBy(*pk).agg(F.sum_distinct("advance").alias("advance_total"),
                                 F.count_distinct("id").alias("advance_count"))
    else:
        per_deal = pj.select(*pk, "id", "advance").distinct()
        pg = per_deal.groupBy(*pk).agg(F.sum("advance").alias("advance_total"),
                                       F.count_distinct("id").alias("advance_count"))
    spine = lenders.select("*", F.explode(_months_array(months)).alias("m")).select("*", "m.year", "m.month").drop("m")
    ps = spine.join(pg, pk, "left").select(
        "facility_lender", "facility_used_by_id",
        F.format_string("%04d-%02d", "year", "month").alias("year_month"),
        zero_if_null("advance_total").cast("decimal(18,2)").alias("advance_total"),
        zero_if_null("advance_count").cast("bigint").alias("advance_count"))
    ps = ps.withColumn("advance_text", money_text("advance_total"))

    out = a.join(ps, ["facility_lender", "facility_used_by_id", "year_month"], "left")
    conv = _rounded_pct("advance_count", "proposed")
    return out.select(
        "facility_lender", "year_month", "legal_name", "trading_style", "facility_used_by_id",
        "is_reporting", "decline", "accept", "accept_val", "pending", "proposed", "proposed_text",
        "accept_rate", "accept_val_text", "advance_total", "advance_count", "advance_text",
        F.when(F.col("proposed") == 0, F.lit(0.0)).otherwise(conv).alias("conversion"),
        F.when(F.col("proposed") == 0, F.lit("N/A"))
         .otherwise(F.concat(conv.cast("bigint").cast("string"), F.lit("%"))).alias("conversion_text"),
    ).orderBy("year_month", "facility_lender", "facility_used_by_id", "legal_name")
