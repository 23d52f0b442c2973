"""Reconciliation by digests: rows are joined only where the two sides differ.

Both sides are cut into cells, first by day, then by key bucket within the days that differ. A cell's digest is its row count and two sums of
64-bit hashes of (key, compared columns); sums do not depend on the order of rows, so they combine on the map side and one row per cell and
task is shuffled. Equal cells hold equal rows and have nothing to report. A row that stands in different cells on the two sides (its date
differs) makes both cells differ, so the join of what is left finds it.

What is read and moved: the compared columns once for the day digests, again for the days that differ (a table stored by day prunes the
others), and the rows of differing cells for the join. A fully agreeing day costs no shuffle of rows. Digests of closed days may be stored and
passed in, then not even those days are scanned.

Rows of a null key never match, as in the plain join, and are always joined. A key is taken to be unique on either side, as MERGE keeps it;
repeated keys that are alike on both sides agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import settlement as st

BUCKETS = 256
NO_DAY = "1900-01-01"  # rows without a day share this day's cells
COMPARED = ["amount", "settlement_date"]


def with_cells(df: DataFrame, key: str, day: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds _day (a date, never null) and _bucket."""
    return df.withColumns({"_day": F.coalesce(F.col(day).cast("date"), F.lit(NO_DAY).cast("date")), "_bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")})


def digests(cells: DataFrame, by: list[str], key: str, compared: list[str]) -> DataFrame:
    """One row per cell: its columns, n and two hash sums."""
    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), key, *compared).cast("decimal(38,0)"))

    return cells.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), total(1).alias("h1"), total(2).alias("h2"))


def differing(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """The cells that only one side has or whose digests differ."""
    other = b.withColumnsRenamed({c: f"_{c}" for c in ("n", "h1", "h2")})
    same = F.lit(True)
    for c in ("n", "h1", "h2"):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return a.join(other, by, "full_outer").filter(~same).select(*by)


def differing_rows(left: DataFrame, right: DataFrame, key: str = "transaction_id", day: str = "settlement_date", compared: list[str] | None = None,
                   buckets: int = BUCKETS, closed: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in cells that differ, and those of a null key. ``closed``: day digests of both sides that were
    stored before, for days that are not to be scanned again."""
    compared = compared or COMPARED
    alike = right.withColumns({c: F.col(c).cast(left.schema[c].dataType) for c in (key, *compared)})  # equal values must hash alike
    sides = [with_cells(d, key, day, buckets) for d in (left, alike)]
    if closed is None:
        of_days = [digests(s, ["_day"], key, compared) for s in sides]
    else:
        known = [r["_day"] for r in closed[0].select("_day").union(closed[1].select("_day")).distinct().collect()]  # days
        open_days = F.lit(True) if not known else ~F.col("_day").isin(known)
        of_days = [c.unionByName(digests(s.filter(open_days), ["_day"], key, compared)) for c, s in zip(closed, sides)]
    days = [r["_day"] for r in differing(*of_days, ["_day"]).collect()]  # one value per day, whatever its rows
    in_days = F.col("_day").isin(days) if days else F.lit(False)
    open_sides = [s.filter(in_days) for s in sides]
    cells = differing(*[digests(s, ["_day", "_bucket"], key, compared) for s in open_sides], ["_day", "_bucket"])
    out = []
    for s, o in zip(sides, open_sides):
        rows = o.filter(F.col(key).isNotNull()).join(cells, ["_day", "_bucket"], "left_semi")
        out.append(rows.unionByName(s.filter(F.col(key).isNull())).drop("_day", "_bucket"))
    return out[0], out[1]


def reconcile_full(fact: DataFrame, settlement: DataFrame, key: str = "transaction_id", buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``settlement.reconcile_full``, joining differing cells only."""
    f, s = differing_rows(*[d.select(key, *COMPARED) for d in (fact, settlement)], key=key, buckets=buckets)
    return st.reconcile_full(f, s, key)


def reconcile_mismatches(fact: DataFrame, settlement: DataFrame, key: str = "transaction_id", buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``settlement.reconcile_mismatches``, joining differing cells only."""
    f, s = differing_rows(*[d.select(key, *COMPARED) for d in (fact, settlement)], key=key, buckets=buckets)
    return st.reconcile_mismatches(f, s, key)
