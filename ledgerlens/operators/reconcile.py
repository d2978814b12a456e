"""Reconcile two versions of a report.

``reconcile_rows``: one row per (key, metric) that differs - or per key that
only one version has - with baseline, comparison, difference (6 dp) and
percent change (2 dp; NULL on a zero or missing base).
``reconcile_summary``: row counts, difference counts over all shared columns and a
MATCH / DIFF verdict. ``reconcile_except``: the symmetric difference of whole
rows, duplicates counted. All are single Spark jobs; nothing is compared on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metrics the comparison looks at (fixed list of the reference's comparer).
DEFAULT_METRICS = ["budget", "budget_rate", "advance_val", "accept_rate"]
DEFAULT_KEYS = ["report_name", "moment"]


def _side(df: DataFrame, keys: list[str], metrics: list[str], tag: str) -> DataFrame:
    return df.select(*keys, *[F.col(m).cast("decimal(38,6)").alias(f"{tag}_{m}") for m in metrics],
                     F.lit(True).alias(f"_{tag}"))


def reconcile_rows(baseline: DataFrame, comparison: DataFrame, keys: list[str] | None = None,
                   metrics: list[str] | None = None) -> DataFrame:
    keys = keys or DEFAULT_KEYS
    metrics = metrics or DEFAULT_METRICS
    j = _side(baseline, keys, metrics, "a").join(_side(comparison, keys, metrics, "b"), keys, "full_outer")
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"a_{m}").alias("baseline"),
                               F.col(f"b_{m}").alias("comparison")) for m in metrics])
    x = j.select(*keys, F.col("_a").isNotNull().alias("in_a"), F.col("_b").isNotNull().alias("in_b"),
                 F.explode(cells).alias("c"))
    b, c = F.col("c.baseline"), F.col("c.comparison")
    status = (F.when(F.col("in_a") & F.col("in_b"), "Present")
               .when(F.col("in_a"), "Missing in comparison").otherwise("Missing in baseline"))
    pct = F.when(b.isNull() | (b == 0), F.lit(None)).otherwise(F.round((c - b) / b * 100, 2))
    out = x.select(*keys, F.col("c.metric").alias("metric"), b.alias("baseline"), c.alias("comparison"),
                   F.round(c - b, 6).cast("decimal(38,6)").alias("difference"),
                   pct.cast("decimal(38,2)").alias("percent_change"), status.alias("status"))
    return out.filter((F.col("status") != "Present") | ~b.eqNullSafe(c))


def reconcile_except(baseline: DataFrame, comparison: DataFrame) -> DataFrame:
    """Rows that one version has more often than the other, over all columns,
    with ``source``: which one. Each version is read once: its rows count +1 or -1, and
    what a row's sum leaves over is repeated that often."""
    cols = baseline.columns
    signed = lambda df, n: df.select(*cols, F.lit(n).alias("_n"))
    over = signed(baseline, 1).unionByName(signed(comparison, -1)).groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n != 0")
    return over.select(*cols, F.when(F.col("_n") > 0, "baseline").otherwise("comparison").alias("source"),
                       F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_k")).drop("_k")


def _compared(baseline: list[str], comparison: list[str], keys: list[str]) -> tuple[list[str], list[str], list[str]]:
    """(columns that both have, missing from the comparison, extra in it)."""
    return ([c for c in baseline if c in comparison and c not in keys],
            sorted(set(baseline) - set(comparison)), sorted(set(comparison) - set(baseline)))


def summary_by(joined: DataFrame, shared: list[str], missing: list[str], extra: list[str], by: list[str]) -> DataFrame:
    """Counts and verdict of a full outer join of two versions (columns a_*,
    b_* and the flags _a, _b), per group of ``by``."""
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    differs = lambda cs: sum((F.when(both & ~F.col(f"a_{m}").eqNullSafe(F.col(f"b_{m}")), 1).otherwise(0) for m in cs), F.lit(0))
    named = [m for m in DEFAULT_METRICS if m in shared]
    g = joined.groupBy(*by).agg(
        F.count("_a").alias("baseline_rows"), F.count("_b").alias("comparison_rows"), F.count(F.when(~both, 1)).alias("rows_missing"),
        F.coalesce(F.sum(differs(named)), F.lit(0)).cast("bigint").alias("value_diffs"),
        F.coalesce(F.sum(differs([m for m in shared if m not in named])), F.lit(0)).cast("bigint").alias("other_diffs"))
    same = ((F.col("rows_missing") == 0) & (F.col("value_diffs") == 0) & (F.col("other_diffs") == 0)
            & (F.col("baseline_rows") == F.col("comparison_rows")) & F.lit(not missing))
    return g.select(*by, "baseline_rows", "comparison_rows", "rows_missing", "value_diffs", "other_diffs",
                    F.lit(",".join(missing)).alias("missing_columns"), F.lit(",".join(extra)).alias("extra_columns"),
                    F.when(same, "MATCH").otherwise("DIFF").alias("verdict"))


def _flagged(df: DataFrame, keys: list[str], cols: list[str], tag: str) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(f"{tag}_{c}") for c in cols), F.lit(True).alias(f"_{tag}"))


def reconcile_summary(baseline: DataFrame, comparison: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: rows per side, keys on one side only, cells that differ
    (``value_diffs``: of the named metrics, ``other_diffs``: of all other shared columns),
    columns only one side has, and the verdict over all of it."""
    keys = keys or DEFAULT_KEYS
    shared, missing, extra = _compared(baseline.columns, comparison.columns, keys)
    j = _flagged(baseline, keys, shared, "a").join(_flagged(comparison, keys, shared, "b"), keys, "full_outer")
    return summary_by(j, shared, missing, extra, [])


def reconcile_cases(baseline: DataFrame, comparison: DataFrame, id_col: str = "case_id", keys: list[str] | None = None) -> DataFrame:
    """One summary row per case, from two frames that hold all cases."""
    keys = [id_col, *(keys or DEFAULT_KEYS)]
    shared, missing, extra = _compared(baseline.columns, comparison.columns, keys)
    j = _flagged(baseline, keys, shared, "a").join(_flagged(comparison, keys, shared, "b"), keys, "full_outer")
    return summary_by(j, shared, missing, extra, [id_col])


def reconcile_tagged(both: DataFrame, second: Column, case: Column, keys: list[str] | None = None) -> DataFrame:
    """``reconcile_cases`` of one frame that holds both versions; ``case``: a row's case, under its
    name, ``second``: whether it is of the comparison (both replace the first column). The
    versions meet in one aggregate, so the frame is made once. A key stands at most
    once in a version."""
    keys = keys or DEFAULT_KEYS
    shared = [c for c in both.columns[1:] if c not in keys]
    side = both.select(case, second.alias("_second"), *both.columns[1:])
    of = lambda c, tag: F.max(F.when(F.col("_second") == (tag == "b"), F.col(c))).alias(f"{tag}_{c}")
    flag = lambda tag: F.max(F.when(F.col("_second") == (tag == "b"), True)).alias(f"_{tag}")
    met = side.groupBy(side.columns[0], *keys).agg(*(of(c, tag) for c in shared for tag in "ab"), flag("a"), flag("b"))
    return summary_by(met, shared, [], [], [side.columns[0]])


def digests(report: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Per ``by`` (a month, say): number of rows and the sum of their 64-bit hashes over ``cols``, which
    does not depend on their order. Two hashes, so that equal sums mean equal rows but for a
    chance of 2**-128."""
    h = lambda *extra: F.sum(F.xxhash64(*cols, *extra).cast("decimal(38,0)"))
    return report.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), h().alias("h1"), h(F.lit(1)).alias("h2"))


def months_that_differ(baseline: DataFrame, comparison: DataFrame, by: list[str], cols: list[str] | None = None) -> DataFrame:
    """The ``by`` groups whose rows are not the same in both versions."""
    cols = cols or baseline.columns
    a, b = (digests(x, by, cols).withColumn("_side", F.lit(k)) for k, x in enumerate((baseline, comparison)))
    sums = a.unionByName(b).groupBy(*by).agg(F.count(F.lit(1)).alias("_sides"), *(F.min(c).alias(f"_low_{c}") for c in ("n", "h1", "h2")),
                                             *(F.max(c).alias(f"_high_{c}") for c in ("n", "h1", "h2")))
    same = F.col("_sides") == 2
    for c in ("n", "h1", "h2"):
        same &= F.col(f"_low_{c}") == F.col(f"_high_{c}")
    return sums.filter(~same).select(*by)


def reconcile_stored(baseline: DataFrame, comparison: DataFrame, by: list[str], id_col: str = "case_id", keys: list[str] | None = None) -> DataFrame:
    """``reconcile_cases`` of two stored versions: digests by ``by`` (some of the keys) first; only groups that
    differ are compared cell by cell, and versions that are equal by all digests never are.
    Both frames should be written: they are read twice."""
    keys = [id_col, *(keys or DEFAULT_KEYS)]
    if not set(by) <= set(keys):
        raise ValueError("digests go by keys of the comparison")
    shared, missing, extra = _compared(baseline.columns, comparison.columns, keys)
    whole = [*keys, *shared]
    differ = months_that_differ(baseline, comparison, [id_col, *(c for c in by if c != id_col)], whole)
    rows = lambda df, name: df.groupBy(id_col).agg(F.count(F.lit(1)).alias(name))
    counts = rows(baseline, "baseline_rows").join(rows(comparison, "comparison_rows"), id_col, "full_outer")
    listed = differ.collect()              # one row a case and month, at most
    none = [F.lit(0).cast("bigint").alias(c) for c in ("rows_missing", "value_diffs", "other_diffs")]
    found = counts.select(id_col, *none).limit(0)
    if listed:
        differ = F.broadcast(baseline.sparkSession.createDataFrame(listed, differ.schema))
        part = lambda df, tag: _flagged(df.join(differ, differ.columns, "left_semi"), keys, shared, tag)
        j = part(baseline, "a").join(part(comparison, "b"), keys, "full_outer")
        found = summary_by(j, shared, missing, extra, [id_col]).select(id_col, "rows_missing", "value_diffs", "other_diffs")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    out = counts.join(found, id_col, "left").select(id_col, *(zero(c) for c in ("baseline_rows", "comparison_rows", "rows_missing", "value_diffs", "other_diffs")))
    same = F.lit(not missing) & (F.col("baseline_rows") == F.col("comparison_rows"))
    for c in ("rows_missing", "value_diffs", "other_diffs"):
        same &= F.col(c) == 0
    return out.select("*", F.lit(",".join(missing)).alias("missing_columns"), F.lit(",".join(extra)).alias("extra_columns"),
                      F.when(same, "MATCH").otherwise("DIFF").alias("verdict"))
