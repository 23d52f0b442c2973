"""Safe casts from landing text to typed columns (ANSI-safe: bad text gives NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_money(c, precision: int = 18, scale: int = 2) -> Column:
    """text -> DECIMAL(18,2), HALF_UP; unparsable -> NULL."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def cast_score(c, precision: int = 3, scale: int = 2) -> Column:
    """text -> DECIMAL(3,2) ('0.155' -> 0.16)."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def cast_timestamp(c) -> Column:
    """ISO text -> TIMESTAMP_NTZ (wall-clock, independent of the session time zone)."""
    return _c(c).try_cast("timestamp_ntz")


def as_of_ts(as_of) -> Column:
    """The evaluation time as a TIMESTAMP_NTZ literal (replaces current_timestamp())."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def parse_failed(raw, parsed) -> Column:
    """True when a non-null input did not parse."""
    return _c(raw).isNotNull() & _c(parsed).isNull()


def with_parsed(df, parsed: dict):
    """Add parsed columns that are computed once per row, even when later filters test them.

    Catalyst pushes a filter below the projection that defines its columns by inlining their
    expressions, so a parse tested by a filter and also selected would run several times per
    row. The parsed values are therefore produced by a one-row explode, whose output a filter
    cannot inline."""
    from pyspark.sql import functions as F
    packed = F.struct(*[c.alias(name) for name, c in parsed.items()])
    out = df.select("*", F.explode(F.array(packed)).alias("_parsed"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_parsed.{n}").alias(n) for n in parsed])
