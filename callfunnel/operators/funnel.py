"""Recommendation / importance-tier funnel: 13 call-level measures per component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.functions.predicates import flag
from callfunnel.operators.status import GRAIN, NO_REASON, eligible

# component prefix -> (recommended flag, prescribed, converted, essential tier, recommended tier)
COMPONENTS = {
    "m": ("m_dss", "meds_rx", "meds_conv", "m_ess", "m_rec"),
    "t": ("t_dss", "tests_rx", "tests_conv", "t_ess", "t_rec"),
    "th": ("th_dss", "ther_rx", "ther_conv", "th_ess", "th_rec"),
}
# reason precedence for a recommended-but-not-prescribed call, per component
NR_REASONS = {
    "m": ("meds_noreq", "meds_norx", "meds_norx_fb"),
    "t": ("tests_norx",),
    "th": ("ther_norx",),
}
MEASURES = ("dss", "dss_norx", "nodss_rx", "rx", "cv", "dss_cv", "nodss_cv",
            "ae", "ae_cv", "er", "er_cv", "or", "or_cv")


def measure_columns(p: str) -> list[tuple[str, Column]]:
    """(name, 0/1 per-call value) for the 13 measures of component `p`."""
    dss, rx, conv, ess, rec = (F.col(c) for c in COMPONENTS[p])
    on = lambda c: c == 1      # noqa: E731
    off = lambda c: c == 0     # noqa: E731
    return [
        (f"{p}_dss", dss),
        (f"{p}_dss_norx", flag(on(dss) & off(rx))),
        (f"{p}_nodss_rx", flag(off(dss) & on(rx))),
        (f"{p}_rx", rx),
        (f"{p}_cv", F.least(rx, conv)),
        (f"{p}_dss_cv", flag(on(dss) & on(rx) & on(conv))),
        (f"{p}_nodss_cv", flag(off(dss) & on(rx) & on(conv))),
        (f"{p}_ae", flag(on(rx) & on(ess) & off(rec))),
        (f"{p}_ae_cv", flag(on(rx) & on(ess) & off(rec) & on(conv))),
        (f"{p}_er", flag(on(rx) & on(ess) & on(rec))),
        (f"{p}_er_cv", flag(on(rx) & on(ess) & on(rec) & on(conv))),
        (f"{p}_or", flag(on(rx) & off(ess) & on(rec))),
        (f"{p}_or_cv", flag(on(rx) & off(ess) & on(rec) & on(conv))),
    ]


MEASURE_NAMES = tuple(f"{p}_{m}" for p in COMPONENTS for m in MEASURES)


def scoped_reason(p: str) -> Column:
    """Not-prescribed reason, only for calls the system recommended but nobody prescribed."""
    dss, rx, *_ = COMPONENTS[p]
    return F.when((F.col(dss) == 1) & (F.col(rx) == 0),
                  F.coalesce(*[F.col(c) for c in NR_REASONS[p]], F.lit(NO_REASON)))


def funnel_grain(calls: DataFrame) -> DataFrame:
    """wk, provider_name, ctype, diag, m_nr, t_nr, th_nr, n, elig, 39 measures."""
    cols = [F.col(c) for c in GRAIN] + [scoped_reason(p).alias(f"{p}_nr") for p in COMPONENTS]
    cols.append(eligible().alias("_elig"))
    for p in COMPONENTS:
        cols += [v.alias(n) for n, v in measure_columns(p)]
    x = calls.select(*cols)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("_elig").alias("elig")]
    aggs += [F.sum(n).alias(n) for n in MEASURE_NAMES]
    return x.groupBy(*GRAIN, "m_nr", "t_nr", "th_nr").agg(*aggs)


def funnel_cells(grain: DataFrame, *more: Column) -> DataFrame:
    """Fold funnel grain rows to one row per cell (calls, elig, 39 measures); `more` are further aggregates by cell."""
    aggs = [F.sum("n").alias("calls"), F.sum("elig").alias("elig")]
    aggs += [F.sum(n).alias(n) for n in MEASURE_NAMES]
    return grain.groupBy(*GRAIN).agg(*aggs, *more)


def funnel_reason_counts(grain: DataFrame) -> DataFrame:
    """Per cell and component: not-prescribed reason -> calls (recommended calls only)."""
    arr = F.array(*[F.struct(F.lit(p).alias("comp"), F.col(f"{p}_nr").alias("reason")) for p in COMPONENTS])
    x = grain.select(*GRAIN, "n", F.explode(arr).alias("_r")).filter(F.col("_r.reason").isNotNull())
    return (x.groupBy(*GRAIN, F.col("_r.comp").alias("comp"), F.col("_r.reason").alias("reason"))
            .agg(F.sum("n").alias("n")))
