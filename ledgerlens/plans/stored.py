"""Funnel inputs from stored facts, or from the month cube while it is current."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import facts as facts_op
from ledgerlens.plans.funnel import FunnelInputs
from ledgerlens.sources.fact_store import FactStore, MonthCube, own_keys
from ledgerlens.sources.snapshots import MONTH


class StoredInputs(FunnelInputs):
    """Report inputs from a ``store``; with a ``cube`` that was made of the store's
    current versions, from the cube. Months come from the manifests."""

    def __init__(self, store: FactStore, account: DataFrame, as_of: dt.date, cube: MonthCube | None = None, window=None):
        super().__init__(store.spark, account, as_of=as_of, window=window)
        self.store, self.cube = store, cube if cube is not None and cube.current(store) else None

    def windowed(self, lo: dt.date, hi: dt.date) -> "StoredInputs":
        return StoredInputs(self.store, self.account, self.as_of, self.cube, (lo, hi))

    def months(self) -> DataFrame:
        return self.store.months(dt.date(self.as_of.year - 3, 1, 1))

    def _cut(self, name: str, window) -> DataFrame:
        """The cube's rows of a fact, within the window."""
        rows, (lo, hi) = self.cube.facts(name), window or (None, None)
        if lo is not None:
            rows = rows.filter(F.col(MONTH) >= f"{lo:%Y-%m}")
        return rows if hi is None else rows.filter(F.col(MONTH) < f"{hi:%Y-%m}")

    @functools.cached_property
    def applications(self) -> DataFrame:
        if self.cube:
            return self._cut("applications", self._since)
        return facts_op.application_facts(self.account, self.store.read("applications", *self._since), self.as_of)

    @functools.cached_property
    def paids(self) -> DataFrame:
        if self.cube:
            return self._cut("paids", self._since)
        return facts_op.paid_facts(self.account, self.store.read("paids", *self._since), self.as_of)

    @functools.cached_property
    def ecof(self) -> DataFrame:
        if self.cube:
            return self._cut("ecof", self.window)
        return facts_op.ecof_facts(self.account, self.store.read("quotes", *(self.window or (None, None))), own_keys(self.account))

    @functools.cached_property
    def budget(self) -> DataFrame:
        return self.cube.facts("budget") if self.cube else facts_op.budget_facts(self.account, self.store.read("budgets"))
