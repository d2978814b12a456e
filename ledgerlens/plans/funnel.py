"""Funnel reports: eCOF -> proposed -> accepted -> paid -> commission -> budget.

One engine covers the report versions (see ``FunnelParams``):

* ``per_facility=False``: one row per moment for the selected scope (a
  facility, a report group, or everything);
* ``per_facility=True`` (latest version): in group mode one row per
  facility of the group and moment, named by trading style, empty rows
  dropped; an unknown group yields the placeholder facility.

Plan shape (each step is a lazy DataFrame; nothing is materialised):

1. month set of the period (<= 12 rows, or the months present in the data);
2. four fact steps, each filtered by scope/lender/months and aggregated to
   (year_month, facility key) - partial aggregation happens map-side;
3. applications LEFT JOIN paid / eCOF / budget on (year_month, key); all four
   inputs are hash-partitioned on the same keys, so the joins reuse the
   aggregation shuffles (no extra exchange);
4. roll up to (key, moment) and attach to the facility x moment spine. The
   spine comes from a generator over the month list (no cross join); by
   default each grain value appears once, ``compat_fanout`` repeats it once
   per month sharing it, which multiplies sums as the reference does.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import calendar as cal_fn
from ledgerlens.functions.filters import any_positive, lender_ci
from ledgerlens.functions.measures import ratio
from ledgerlens.operators import facts as facts_op
from ledgerlens.sources import domain
from ledgerlens.sources.tables import Tables

# Fixed labels of the report (values must equal the reference's output).
DEFAULT_COMPANY = "Consumer Credit Solutions"
UNKNOWN_GROUP = "Unknown Group"
ALL_LENDERS = "All"

ALL_KEY = "*"   # facility key when the report is not split by facility

MEASURES = ["ecof_count", "ecof_advance", "proposed_count", "accept_count", "accept_val",
            "accept_avg", "accept_rate", "decline_count", "pending_count", "advance_count",
            "advance_val", "advance_avg", "commission_val", "commission_rate_avg",
            "budget", "budget_rate"]
NONEMPTY = ["ecof_count", "ecof_advance", "proposed_count", "accept_count", "accept_val",
            "decline_count", "pending_count", "advance_count", "advance_val",
            "commission_val", "budget"]


@dataclasses.dataclass(frozen=True)
class FunnelParams:
    facility: str | None = None
    group: str | None = None
    lender: str | None = None
    period: str | None = "L12M"
    group_by: str = "year_month"
    as_of: dt.date = domain.AS_OF
    per_facility: bool = True
    include_budget: bool = True
    budget_agg: str = "sum"          # "max": early versions
    compat_fanout: bool = False      # reproduce the grain fan-out literally
    lender_on_ecof: bool = True      # early versions ignored the lender for eCOF
    drop_empty: bool | None = None   # default: per-facility group mode
    spine: str = "applications"      # "union": months with any fact, not only those with applications

    def validate(self) -> "FunnelParams":
        if self.period is not None and self.period not in cal_fn.PERIODS:
            raise ValueError("Invalid period. Valid values are L12M, P12M, C12M, or None.")
        cal_fn.check_grain(self.group_by)
        if self.budget_agg not in ("sum", "max"):
            raise ValueError("budget_agg must be 'sum' or 'max'")
        if self.spine not in ("applications", "union"):
            raise ValueError("spine must be 'applications' or 'union'")
        return self


class FunnelInputs:
    """Inputs of the funnel: account and the four fact views, each planned when
    it is first asked for, so a report of one fact opens that fact's tables only.

    Facts start four years back (from January of that year) unless ``window``
    is narrower. Frames that are given stand for those of ``tables``."""

    def __init__(self, spark: SparkSession, account: DataFrame | None = None, applications: DataFrame | None = None,
                 paids: DataFrame | None = None, ecof: DataFrame | None = None, budget: DataFrame | None = None,
                 tables: Tables | None = None, as_of: dt.date = domain.AS_OF, window: domain.Window | None = None):
        self.spark, self.tables, self.as_of, self.window = spark, tables, as_of, window
        given = {"account": account, "applications": applications, "paids": paids, "ecof": ecof, "budget": budget}
        self.__dict__.update({k: v for k, v in given.items() if v is not None})

    @functools.cached_property
    def account(self) -> DataFrame:
        return domain.account(self.tables)

    @property
    def _since(self) -> domain.Window:
        return self.window or (dt.date(self.as_of.year - 3, 1, 1), None)

    @functools.cached_property
    def applications(self) -> DataFrame:
        return facts_op.application_facts(self.account, domain.application_mth(self.tables, window=self._since), self.as_of)

    @functools.cached_property
    def paids(self) -> DataFrame:
        return facts_op.paid_facts(self.account, domain.paid_mth(self.tables, window=self._since), self.as_of)

    @functools.cached_property
    def ecof(self) -> DataFrame:
        return facts_op.ecof_facts(self.account, domain.vw_ecof_all(self.tables, window=self.window), domain.account_ecof(self.tables))

    @functools.cached_property
    def budget(self) -> DataFrame:
        return facts_op.budget_facts(self.account, domain.paid_budget(self.tables))

    def windowed(self, lo: dt.date, hi: dt.date) -> "FunnelInputs":
        """Same inputs with applications, paid deals and quotes restricted to
        ``lo <= date < hi`` on the raw date columns, so a 12-month report
        reads 12 months of facts (pushed parquet filters; partition pruning
        on date-partitioned storage). Budget stays whole: its quarterly
        values are sums over whole years."""
        if self.tables is None:
            return self
        return FunnelInputs(self.spark, tables=self.tables, as_of=self.as_of, window=(lo, hi))

    def months(self) -> DataFrame | None:
        """Months that have applications or paid deals, if they are known without a scan of the facts."""
        return None

    @classmethod
    def from_tables(cls, t: Tables, as_of: dt.date = domain.AS_OF, window: domain.Window | None = None) -> "FunnelInputs":
        return cls(t.spark, tables=t, as_of=as_of, window=window)


# --------------------------------------------------------------------------
# steps (the modular version's sub-procedures)
# --------------------------------------------------------------------------

def filtered_moments(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    if p.period is None and (months := inp.months()) is not None:
        return months.select(*cal_fn.month_fields(F.col("year_month")))
    return cal_fn.filtered_moments(inp.spark, p.as_of, p.period, inp.applications, inp.paids)


def report_months(p: FunnelParams) -> list[tuple] | None:
    """The period's month rows, from its parameters; None: those in the data."""
    return None if p.period is None else cal_fn.month_list(*cal_fn.period_bounds(p.period, p.as_of))


def report_inputs(inp: FunnelInputs, p: FunnelParams) -> FunnelInputs:
    """The inputs, with the period's window on the fact scans."""
    return inp if p.period is None else inp.windowed(*cal_fn.period_bounds(p.period, p.as_of))


def _group_mode(p: FunnelParams) -> bool:
    return p.per_facility and p.group is not None


def facilities(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    """(fkey, facility_used_by_id, facility_used_by_name) rows of the report.

    Group mode: the group's distinct facilities by trading style, or the
    placeholder when the group is unknown. Otherwise one row: the facility's
    legal name, or the default company label.
    """
    if _group_mode(p):
        f = inp.account.filter(F.col("facility_used_by_report_group_id") == p.group)
        if p.facility is not None:
            f = f.filter(F.col("facility_used_by_id") == p.facility)
        f = f.select(F.col("facility_used_by_id").alias("fkey"), "facility_used_by_id",
                     F.col("facility_used_by_trading_style").alias("facility_used_by_name")).distinct()
        # NOT EXISTS guard, in the plan: the placeholder stands where no row does
        some = f.limit(1).agg(F.count(F.lit(1))).scalar()
        placeholder = inp.spark.range(1).filter(some == 0).select(
            F.lit(ALL_KEY).alias("fkey"), F.lit(None).cast("string").alias("facility_used_by_id"),
            F.lit(UNKNOWN_GROUP).alias("facility_used_by_name"))
        return f.unionByName(placeholder)
    return report_name_frame(inp, p).select(
        F.lit(ALL_KEY).alias("fkey"), F.lit(p.facility).cast("string").alias("facility_used_by_id"),
        F.col("name").alias("facility_used_by_name"))


def report_name_frame(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    """One row ``name``: group name if a group is given (and the report is not
    split by facility), else the facility's legal name, else the default.

    A global aggregate always yields exactly one row (NULL when nothing
    matches), so no driver round trip is needed."""
    a = inp.account
    if p.group is not None and not p.per_facility:
        n = a.filter(F.col("facility_used_by_report_group_id") == p.group) \
             .agg(F.min("facility_used_by_report_group").alias("n"))
    elif p.facility is not None:
        n = a.filter(F.col("facility_used_by_id") == p.facility) \
             .agg(F.min("facility_used_by_legal_name").alias("n"))
    else:
        return inp.spark.range(1).select(F.lit(DEFAULT_COMPANY).alias("name"))
    return n.select(F.coalesce(F.col("n"), F.lit(DEFAULT_COMPANY)).alias("name"))


def report_name(name_col, lender: str | None):
    return F.concat(name_col, F.lit(" : "), F.lit(lender if lender is not None else ALL_LENDERS))


def _scope(df: DataFrame, p: FunnelParams, group_col: str, lender: bool = True) -> DataFrame:
    if p.group is not None:
        df = df.filter(F.col(group_col) == p.group)
    if p.facility is not None:
        df = df.filter(F.col("facility_used_by_id") == p.facility)
    if lender:
        df = lender_ci(df, p.lender)
    return df


def _fkey(p: FunnelParams):
    return F.col("facility_used_by_id") if _group_mode(p) else F.lit(ALL_KEY)


def _in_months(df: DataFrame, months: list[str] | None) -> DataFrame:
    return df if months is None else df.filter(F.col("year_month").isin(months))


def step_applications(inp: FunnelInputs, p: FunnelParams, months: list[str] | None) -> DataFrame:
    a = _in_months(_scope(inp.applications, p, "facility_used_by_report_group_id"), months)
    return a.groupBy("year_month", _fkey(p).alias("fkey")).agg(
        F.sum("accept_val").cast("decimal(18,2)").alias("accept_val"),
        F.sum("accept").cast("bigint").alias("accept"),
        F.sum("decline").cast("bigint").alias("decline"),
        F.sum("pending").cast("bigint").alias("pending"),
        F.sum(F.col("accept") + F.col("decline")).cast("bigint").alias("proposed"))


def step_paids(inp: FunnelInputs, p: FunnelParams, months: list[str] | None) -> DataFrame:
    x = _in_months(_scope(inp.paids, p, "facility_used_by_report_group_id"), months)
    g = x.groupBy("year_month", _fkey(p).alias("fkey")).agg(
        F.sum("advance").cast("decimal(18,2)").alias("advance"),
        F.sum("advance_count").cast("bigint").alias("advance_count"),
        F.sum("commission").cast("decimal(18,2)").alias("commission"))
    return g.withColumn("commission_rate_avg", ratio("commission", "advance", "decimal(18,4)"))


def step_ecof(inp: FunnelInputs, p: FunnelParams, months: list[str] | None) -> DataFrame:
    e = _in_months(_scope(inp.ecof, p, "report_group_id", lender=p.lender_on_ecof), months)
    return e.groupBy("year_month", _fkey(p).alias("fkey")).agg(
        F.sum("ecof_count").cast("bigint").alias("ecof_count"),
        F.sum("ecof_advance").cast("decimal(18,2)").alias("ecof_advance"))


def step_budget(inp: FunnelInputs, p: FunnelParams, months: list[str] | None) -> DataFrame:
    b = _in_months(_scope(inp.budget, p, "facility_used_by_report_group_id"), months)
    agg = F.sum if p.budget_agg == "sum" else F.max
    return b.groupBy("year_month", _fkey(p).alias("fkey")).agg(
        agg("budget").cast("decimal(18,2)").alias("budget"))


def monthly_result(inp: FunnelInputs, p: FunnelParams, months: list[str] | None) -> DataFrame:
    """Facts per (year_month, fkey), hanging off applications (months with
    paid/eCOF/budget but no applications are absent, as in the reference) or,
    with ``spine="union"``, off whatever fact there is."""
    keys = ["year_month", "fkey"]
    how = "left" if p.spine == "applications" else "full_outer"
    r = (step_applications(inp, p, months)
         .join(step_paids(inp, p, months).drop("commission_rate_avg"), keys, how)
         .join(step_ecof(inp, p, months), keys, how))
    if p.include_budget:
        r = r.join(step_budget(inp, p, months), keys, how)
    return r


def _grain_of_month(group_by: str):
    ym = F.col("year_month")
    y = F.substring(ym, 1, 4)
    m = F.substring(ym, 6, 2).cast("int")
    q = F.floor((m - 1) / 3).cast("int") + 1
    return {"year_month": ym, "year": y, "month": m.cast("string"), "quarter": q.cast("string"),
            "year_quarter": F.concat(y, F.lit("-"), q.cast("string"))}[group_by]


def spine_moments(inp: FunnelInputs, p: FunnelParams) -> Column:
    """Array of the report's grain values: each once, or (fan-out) once for
    every month that has it. Months of the data come as a scalar subquery; there
    are twelve of them a year."""
    months = report_months(p)
    if months is None:
        every = F.collect_list if p.compat_fanout else F.collect_set
        return filtered_moments(inp, p).agg(F.array_sort(every(cal_fn.grain_value(p.group_by)))).scalar()
    values = [str(r[cal_fn.MONTH_COLUMNS.index(p.group_by)]) for r in months]
    return F.array(*(F.lit(v) for v in (values if p.compat_fanout else sorted(set(values)))))


SUMS = ["ecof_count", "ecof_advance", "proposed", "accept", "accept_val", "decline", "pending",
        "advance_count", "advance", "commission"]


def report_measures(include_budget: bool) -> list[Column]:
    """The report's columns from the summed facts, ``moment`` first."""
    out = [
        F.col("moment"),
        F.col("ecof_count").cast("bigint").alias("ecof_count"),
        F.col("ecof_advance").cast("decimal(18,2)").alias("ecof_advance"),
        F.col("proposed").cast("bigint").alias("proposed_count"),
        F.col("accept").cast("bigint").alias("accept_count"),
        F.col("accept_val").cast("decimal(18,2)").alias("accept_val"),
        ratio("accept_val", "accept", "decimal(18,2)").alias("accept_avg"),
        ratio("accept", "acc_dec", "decimal(18,6)").alias("accept_rate"),
        F.col("decline").cast("bigint").alias("decline_count"),
        F.col("pending").cast("bigint").alias("pending_count"),
        F.col("advance_count").cast("bigint").alias("advance_count"),
        F.col("advance").cast("decimal(18,2)").alias("advance_val"),
        ratio("advance", "advance_count", "decimal(18,2)").alias("advance_avg"),
        F.col("commission").cast("decimal(18,2)").alias("commission_val"),
        ratio("commission", "advance", "decimal(18,4)").alias("commission_rate_avg"),
    ]
    if include_budget:
        out += [F.col("budget").cast("decimal(18,2)").alias("budget"),
                ratio("advance", "budget", "decimal(18,6)").alias("budget_rate")]
    return out


def assemble(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    """Spine (facility x moment) LEFT JOIN facts rolled up to the grain."""
    rows = report_months(p)
    months = None if rows is None else [r[0] for r in rows]
    r = monthly_result(inp, p, months).withColumn("moment", _grain_of_month(p.group_by))
    sums = [F.sum(c).alias(c) for c in SUMS]
    sums.append(F.sum(F.col("accept") + F.col("decline")).alias("acc_dec"))
    if p.include_budget:
        sums.append(F.sum("budget").alias("budget"))
    rg = r.groupBy("fkey", "moment").agg(*sums)

    fac = facilities(inp, p)
    spine = fac.select("fkey", "facility_used_by_id", "facility_used_by_name",
                       F.explode(spine_moments(inp, p)).alias("moment"))
    j = spine.join(rg, ["fkey", "moment"], "left")
    if p.compat_fanout:
        # the spine repeats a grain value once per month: sums multiply
        again = [F.sum(c).alias(c) for c in rg.columns if c not in ("fkey", "moment")]
        j = j.groupBy("fkey", "facility_used_by_id", "facility_used_by_name", "moment").agg(*again)

    res = j.select(report_name(F.col("facility_used_by_name"), p.lender).alias("report_name"),
                   *report_measures(p.include_budget), F.col("facility_used_by_id").alias("_fid"))
    drop = p.drop_empty if p.drop_empty is not None else _group_mode(p)
    if drop:
        res = res.filter(any_positive([c for c in NONEMPTY if c in res.columns]))
    return res


def funnel(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    """The report; sorted by report name then moment (numeric grains as numbers)."""
    p.validate()
    res = assemble(report_inputs(inp, p), p)
    return (res.orderBy("report_name", cal_fn.grain_sort_key(p.group_by), "_fid")
               .drop("_fid"))


def _case_places(inp: FunnelInputs, cases: dict[int, FunnelParams]) -> DataFrame:
    """(case_id, fkey, facility_used_by_id, facility_used_by_name) of all cases, as ``facilities``
    gives them case by case: the distinct places are dealt out to the cases that name them, and a
    case that no place answers gets its placeholder."""
    names = {"facility": "facility_used_by_legal_name", "group": "facility_used_by_report_group", "each": "facility_used_by_trading_style"}
    places = inp.account.select("facility_used_by_id", "facility_used_by_report_group_id", *names.values()).distinct()
    takes, labels = [], []
    for k, p in cases.items():
        each = _group_mode(p)
        own = F.lit(True)
        if p.group is not None:
            own &= F.col("facility_used_by_report_group_id") == p.group
        if p.facility is not None and (each or p.group is None):
            own &= F.col("facility_used_by_id") == p.facility
        labels.append((k, UNKNOWN_GROUP if each else DEFAULT_COMPANY, None if each else p.facility))
        if p.group is None and p.facility is None:
            continue
        name = F.col(names["each" if each else "group" if p.group is not None else "facility"])
        takes.append(F.when(own, F.struct(
            F.lit(k).alias("case_id"), (F.col("facility_used_by_id") if each else F.lit(ALL_KEY)).alias("fkey"),
            (F.col("facility_used_by_id") if each else F.lit(p.facility).cast("string")).alias("facility_used_by_id"),
            (name if each else F.lit(None).cast("string")).alias("own_name"), name.alias("name"))))
    case_rows = inp.spark.createDataFrame(labels, "case_id int, label string, named string")
    if not takes:
        return case_rows.select("case_id", F.lit(ALL_KEY).alias("fkey"), F.col("named").alias("facility_used_by_id"), F.col("label").alias("facility_used_by_name"))
    dealt = (places.select(F.explode(F.array_compact(F.array(*takes))).alias("c")).select("c.*")
             .groupBy("case_id", "fkey", "facility_used_by_id", "own_name").agg(F.min("name").alias("name")))
    return F.broadcast(case_rows).join(dealt, "case_id", "right").unionByName(
        case_rows.join(dealt.select("case_id").distinct(), "case_id", "left_anti").select(
            "*", F.lit(ALL_KEY).alias("fkey"), F.col("named").alias("facility_used_by_id"), F.lit(None).cast("string").alias("own_name"),
            F.lit(None).cast("string").alias("name"))).select(
        "case_id", "fkey", "facility_used_by_id", F.coalesce("own_name", "name", "label").alias("facility_used_by_name"))


def funnel_cases(inp: FunnelInputs, cases: dict[int, FunnelParams]) -> DataFrame:
    """The reports of several parameter sets at once, tagged ``case_id``; whatever
    parameters ``funnel`` takes, each case may have. The budget columns of a case without budgets
    are null.

    Each fact is scanned and summed to (month, facility, group, lender) once, however many
    cases there are; the sums are then dealt out to the cases that select them (an array of cases
    per row, exploded)."""
    for p in cases.values():
        p.validate()
    if all(p.period is not None for p in cases.values()):
        bounds = [cal_fn.period_bounds(p.period, p.as_of) for p in cases.values()]
        inp = inp.windowed(min(b[0] for b in bounds), max(b[1] for b in bounds))
    month = F.col("year_month")

    def dealt(facts: DataFrame, group_col: str, aggs: dict, ecof: bool = False, wanted=lambda p: True) -> DataFrame:
        keys = [F.col("year_month"), F.col("facility_used_by_id"), F.col(group_col).alias("grp"), F.upper("facility_lender").alias("lender")]
        once = facts.groupBy(*keys).agg(*(f(c).alias(c) for c, f in aggs.items()))
        takes = []
        for k, p in cases.items():
            if not wanted(p):
                continue
            own = F.lit(True) if p.period is None else month.isin([r[0] for r in report_months(p)])
            if p.group is not None:
                own &= F.col("grp") == p.group
            if p.facility is not None:
                own &= F.col("facility_used_by_id") == p.facility
            if p.lender is not None and (p.lender_on_ecof or not ecof):
                own &= F.col("lender") == F.upper(F.lit(p.lender))
            takes.append(F.when(own, F.struct(F.lit(k).alias("case_id"), _fkey(p).alias("fkey"))))
        return once.withColumn("to", F.explode(F.array_compact(F.array(*takes)))).select("year_month", "to.case_id", "to.fkey", *aggs).groupBy(
            "year_month", "case_id", "fkey").agg(*(f(c).alias(c) for c, f in aggs.items()))

    union = [k for k, p in cases.items() if p.spine == "union"]
    keys, how = ["year_month", "case_id", "fkey"], "full_outer" if union else "left"
    apps = inp.applications.withColumn("proposed", F.col("accept") + F.col("decline")).withColumn("seen", F.lit(1))
    r = (dealt(apps, "facility_used_by_report_group_id", dict.fromkeys(("accept_val", "accept", "decline", "pending", "proposed"), F.sum) | {"seen": F.max})
         .join(dealt(inp.paids, "facility_used_by_report_group_id", dict.fromkeys(("advance", "advance_count", "commission"), F.sum)), keys, how)
         .join(dealt(inp.ecof, "report_group_id", dict.fromkeys(("ecof_count", "ecof_advance"), F.sum), ecof=True), keys, how))
    if any(p.include_budget for p in cases.values()):
        r = r.join(dealt(inp.budget.withColumn("budget_max", F.col("budget")), "facility_used_by_report_group_id",
                         {"budget": F.sum, "budget_max": F.max}, wanted=lambda p: p.include_budget), keys, how)
    else:
        r = r.withColumn("budget", F.lit(None).cast("decimal(18,6)")).withColumn("budget_max", F.col("budget"))
    if union:
        r = r.filter(F.col("seen").isNotNull() | F.col("case_id").isin(union))

    def per_case(value) -> Column:
        out = F.lit(None)
        for k, p in cases.items():
            out = F.when(F.col("case_id") == k, value(p)).otherwise(out)
        return out

    r = r.withColumn("moment", per_case(lambda p: _grain_of_month(p.group_by)))
    r = r.withColumn("budget", per_case(lambda p: F.col("budget" if p.budget_agg == "sum" else "budget_max").cast("decimal(18,2)")))
    r = r.withColumn("acc_dec", F.col("accept") + F.col("decline"))
    sums = [*SUMS, "acc_dec", "budget"]
    rg = r.groupBy("case_id", "fkey", "moment").agg(*(F.sum(c).alias(c) for c in sums))
    spine = _case_places(inp, cases).select(
        "case_id", "fkey", "facility_used_by_id",
        per_case(lambda p: report_name(F.col("facility_used_by_name"), p.lender)).alias("report_name"),
        F.explode(per_case(lambda p: spine_moments(inp, p))).alias("moment"))
    if any(p.compat_fanout for p in cases.values()):      # a grain value counts once for every month that has it
        spine = spine.groupBy(*spine.columns).agg(F.count(F.lit(1)).alias("times"))
        rg = spine.join(rg, ["case_id", "fkey", "moment"], "left").select(
            "case_id", "report_name", "moment", *((F.col(c) * F.col("times")).alias(c) for c in sums))
    else:
        rg = spine.join(rg, ["case_id", "fkey", "moment"], "left")
    res = rg.select("case_id", "report_name", *report_measures(True))
    drop = [k for k, p in cases.items() if (p.drop_empty if p.drop_empty is not None else _group_mode(p))]
    return res.filter(~F.col("case_id").isin(drop) | any_positive(NONEMPTY)) if drop else res


def cases_of(parameters: DataFrame, **common) -> dict[int, FunnelParams]:
    """Cases that a parameter file lists (see ``sources.files.PARAMETER_SCHEMA``); an empty
    period means the months of the data. Its rows are parameters, read on the driver."""
    return {r.test_id: FunnelParams(facility=r.facility_used_by_id, group=r.report_group_id, lender=r.facility_lender,
                                    period=r.period, group_by=r.group_by, **common) for r in parameters.collect()}


def funnel_text(inp: FunnelInputs, p: FunnelParams) -> DataFrame:
    """Funnel with text columns (money as '£' + N0, rates as text). The lender
    filter does not apply to quotes in this version.

    Text is formatted from the report's sums (not from the rounded averages),
    so '£' averages and the N2 commission rate round once."""
    from ledgerlens.functions.measures import money_text, pct2_text

    def q(n, d):
        return F.when(F.col(d) > 0, F.col(n).cast("decimal(28,8)") / F.col(d).cast("decimal(28,8)"))

    r = funnel(inp, dataclasses.replace(p, include_budget=False, lender_on_ecof=False))
    return r.select(
        "report_name", F.col("moment").alias("group_by"), "ecof_count", "ecof_advance",
        money_text("ecof_advance").alias("ecof_advance_text"),
        "proposed_count", "accept_count", "accept_val",
        money_text("accept_val").alias("accept_text"),
        money_text(q("accept_val", "accept_count")).alias("accept_avg_text"),
        F.concat((q("accept_count", "proposed_count") * 100).cast("decimal(18,6)").cast("string"),
                 F.lit("%")).alias("accept_rate_text"),
        "decline_count", "pending_count", "advance_count", "advance_val",
        money_text("advance_val").alias("advance_text"),
        money_text(q("advance_val", "advance_count")).alias("advance_avg_text"),
        "commission_val", money_text("commission_val").alias("commission_text"),
        "commission_rate_avg",
        pct2_text(q("commission_val", "advance_val")).alias("commission_rate_avg_text"))
