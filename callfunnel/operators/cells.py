"""Grain cells: fold tab grains into per-cell counts, reason maps, metrics, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.operators.status import GRAIN, TABS, outcome_kind

TAB_ORDER = {t: i for i, t in enumerate(TABS)}
COUNTS = ("calls", "elig", "rx", "cv", "nc", "nr", "ne")
FILTERS = ("provider_name", "ctype", "diag")


def grain_cells(tabs: DataFrame) -> DataFrame:
    """Per cell and tab: calls, elig, rx, cv, nc, nr, ne (all counts)."""
    k = outcome_kind(F.col("status"), F.col("elig"))

    def count_of(kind: str) -> Column:
        return F.sum(F.when(k == kind, F.col("n")).otherwise(F.lit(0))).alias(kind)

    c = tabs.groupBy(*GRAIN, "tab").agg(count_of("cv"), count_of("nc"), count_of("nr"), count_of("ne"))
    return c.select(*GRAIN, "tab",
                    (F.col("cv") + F.col("nc") + F.col("nr") + F.col("ne")).alias("calls"),
                    (F.col("cv") + F.col("nc") + F.col("nr")).alias("elig"),
                    (F.col("cv") + F.col("nc")).alias("rx"),
                    "cv", "nc", "nr", "ne")


def grain_reason_counts(tabs: DataFrame) -> DataFrame:
    """Per cell, tab and kind (nc / nr / ne): reason -> count (flat form of the maps)."""
    k = outcome_kind(F.col("status"), F.col("elig"))
    reason = F.when(k == "ne", F.col("ne_reason")).otherwise(F.substr(F.col("status"), F.lit(4)))
    x = tabs.select(*GRAIN, "tab", k.alias("kind"), reason.alias("reason"), "n").filter(F.col("kind") != "cv")
    return x.groupBy(*GRAIN, "tab", "kind", "reason").agg(F.sum("n").alias("n"))


def cell_envelope(cells: DataFrame, *more: Column) -> DataFrame:
    """Cross-tab view per cell: calls and elig = max over tabs; `ne_tab` = the tab whose
    not-eligible breakdown is kept (largest total, ties to the earlier tab in
    meds, tests, therapy; NULL when no call in the cell is ineligible).
    `more` are further aggregates by cell."""
    order = F.create_map(*[x for t, i in TAB_ORDER.items() for x in (F.lit(t), F.lit(i))])
    rank_key = F.struct(F.col("ne"), -F.element_at(order, F.col("tab")))
    g = cells.groupBy(*GRAIN).agg(
        F.max("calls").alias("calls"), F.max("elig").alias("elig"), F.max("ne").alias("ne"),
        F.max_by("tab", rank_key).alias("_best"), *more)
    return (g.withColumn("ne_tab", F.when(F.col("ne") > 0, F.col("_best")))
            .select(*GRAIN, "calls", "elig", "ne", "ne_tab", *g.columns[len(GRAIN) + 4:]))


def reconcile_totals(tabs: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """One row: call totals per tab, drift = max - min, status ok / warn / fail."""
    tot = {t: F.sum(F.when(F.col("tab") == t, F.col("n")).otherwise(F.lit(0))) for t in TABS}
    r = tabs.agg(*[v.alias(f"{t}_total") for t, v in tot.items()])
    cols = [F.col(f"{t}_total") for t in TABS]
    hi, lo = F.greatest(*cols), F.least(*cols)
    drift = hi - lo
    status = (F.when(drift > hi * F.lit(tolerance), F.lit("fail")).when(drift > 0, F.lit("warn"))
              .otherwise(F.lit("ok")))
    return r.select(*cols, drift.alias("drift"), status.alias("status"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, F.round(num.cast("double") / den.cast("double"), 6))


def weekly_metrics(cells: DataFrame, by=("wk", "tab")) -> DataFrame:
    """Week-on-week metrics per tab: calls, eligible, prescribed, converted, gaps, ratios."""
    g = cells.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return g.select(
        *by, "calls", "elig", F.col("rx").alias("prescribed"), F.col("cv").alias("converted"),
        F.col("nc").alias("not_converted"), F.col("nr").alias("not_prescribed"), F.col("ne").alias("not_eligible"),
        _ratio(F.col("nr"), F.col("calls")).alias("not_prescribed_pct_of_calls"),
        _ratio(F.col("nr"), F.col("elig")).alias("not_prescribed_pct_of_eligible"),
        _ratio(F.col("nc"), F.col("rx")).alias("not_converted_pct"))


def weekly_filtered(cells: DataFrame, providers=None, ctypes=None, diags=None) -> DataFrame:
    """Weekly metrics restricted to chosen providers / call types / diagnoses."""
    c = cells
    if providers:
        c = c.filter(F.col("provider_name").isin(*providers))
    if ctypes:
        c = c.filter(F.col("ctype").isin(*ctypes))
    if diags:
        c = c.filter(F.col("diag").isin(*diags))
    return weekly_metrics(c)


def filter_cube(cells: DataFrame, by=("wk", "tab")) -> DataFrame:
    """level, `by`, the filters and the counts, for each of the eight sets of filters that a reader may leave open.

    `level` has a bit per filter (4 provider, 2 call type, 1 diagnosis) that is set where the filter is open,
    so an open filter's NULL isn't taken for a missing name. Cells are combined per task before the one shuffle.
    """
    sets = [[*by, *[f for i, f in enumerate(FILTERS) if not level >> (len(FILTERS) - 1 - i) & 1]] for level in range(1 << len(FILTERS))]
    g = cells.groupingSets(sets, *by, *FILTERS)
    return g.agg(F.grouping_id().alias("level"), *[F.sum(c).alias(c) for c in COUNTS])


def weekly_from_cube(cube: DataFrame, providers=None, ctypes=None, diags=None) -> DataFrame:
    """`weekly_filtered` read from the cube: the rows of one level, restricted to the chosen values."""
    chosen = dict(zip(FILTERS, (providers, ctypes, diags)))
    level = sum(1 << (len(FILTERS) - 1 - i) for i, f in enumerate(FILTERS) if not chosen[f])
    c = cube.filter(F.col("level") == level)
    for f, values in chosen.items():
        if values:
            c = c.filter(F.col(f).isin(*values))
    return weekly_metrics(c)


def reason_breakdown(reasons: DataFrame) -> DataFrame:
    """Reason totals for both gaps (and not-eligible) per tab."""
    return reasons.groupBy("tab", "kind", "reason").agg(F.sum("n").alias("n"))
