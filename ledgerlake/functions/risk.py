"""Risk level / class / category derivations as WHEN chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def derive_risk_level(score) -> Column:
    """< 0.25 LOW, < 0.5 MEDIUM, < 0.75 HIGH, else CRITICAL (a NULL score falls through to CRITICAL)."""
    s = _c(score)
    out = None
    for label, cut in K.RISK_LEVEL_CUTS:
        cond = s < F.lit(cut)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("CRITICAL")


def derive_risk_class_b(score) -> Column:
    """>= 0.8 HIGH, >= 0.5 MODERATE, >= 0.2 LOW, else MINIMAL."""
    s = _c(score)
    out = None
    for label, cut in K.RISK_CLASS_B_CUTS:
        cond = s >= F.lit(cut)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("MINIMAL")


def overall_risk_category(decision, score) -> Column:
    """DECLINED/BLOCKED -> HIGH_RISK; CHALLENGED -> MEDIUM_RISK; score > 0.5 -> MEDIUM_RISK;
    > 0.25 -> LOW_RISK; else APPROVED. A NULL comparison is false, as in SQL."""
    d, s = _c(decision), _c(score)
    return (F.when(d.isin("DECLINED", "BLOCKED"), "HIGH_RISK")
            .when(d == "CHALLENGED", "MEDIUM_RISK")
            .when(s > F.lit(0.5), "MEDIUM_RISK")
            .when(s > F.lit(0.25), "LOW_RISK")
            .otherwise("APPROVED"))


def customer_risk_class(avg_score) -> Column:
    s = _c(avg_score)
    out = None
    for label, cut in K.CUSTOMER_RISK_CUTS:
        cond = s > F.lit(cut)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise("LOW_RISK")


def score_to_level(score) -> Column:
    """Fraud engine: >= 0.75 CRITICAL, >= 0.5 HIGH, >= 0.25 MEDIUM, else LOW (lower-case enum values)."""
    s = _c(score)
    return (F.when(s >= F.lit(0.75), "critical").when(s >= F.lit(0.5), "high")
            .when(s >= F.lit(0.25), "medium").otherwise("low"))


def decide(level, alerts) -> Column:
    """critical -> block; high -> decline if an escalating alert is present else review;
    medium -> challenge; low -> approve."""
    lv, al = _c(level), _c(alerts)
    escalate = F.arrays_overlap(al, F.array(*[F.lit(a) for a in K.ESCALATING_ALERTS]))
    return (F.when(lv == "critical", "block")
            .when((lv == "high") & F.coalesce(escalate, F.lit(False)), "decline")
            .when(lv == "high", "review")
            .when(lv == "medium", "challenge")
            .otherwise("approve"))


def is_high_risk(level) -> Column:
    return F.lower(_c(level)).isin("high", "critical")


def should_decline(decision) -> Column:
    return F.lower(_c(decision)).isin("decline", "block")


def pct_rate(numerator, denominator) -> Column:
    """numerator / NULLIF(denominator, 0) * 100 as DOUBLE."""
    den = _c(denominator)
    return _c(numerator).cast("double") / F.when(den != 0, den) * F.lit(100.0)
