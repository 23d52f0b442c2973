"""Per-call context for registered queries: fixtures and the medallion DAG over one sf dir."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures
from ..sources.fixtures import AS_OF
from .medallion import Medallion


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str, payments: str = "fx_payments_raw",
                 as_of: str = AS_OF, days: int = 90, calendar_days: int = 730):
        self.spark = spark
        self.sf_dir = sf_dir
        self.payments_source = payments
        self.as_of = as_of
        self.days = days
        self.calendar_days = calendar_days
        self._memo: dict = {}

    def fx(self, name: str) -> DataFrame:
        return fixtures.fixture(self.spark, self.sf_dir, name, self._memo)

    @cached_property
    def med(self) -> Medallion:
        return Medallion(self.spark, self.fx(self.payments_source), self.fx("fx_fraud_signals_raw"),
                         self.as_of, self.days, self.calendar_days)
