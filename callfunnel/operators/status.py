"""Per-call outcome per tab (meds / tests / therapy), eligibility, and tab grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = ("wk", "provider_name", "ctype", "diag")
TABS = ("meds", "tests", "therapy")

# FIXED VALUES: outcome prefixes and fallback reason labels.
CONVERTED = "cv"
NOT_CONVERTED = "nc:"
NOT_PRESCRIBED = "nr:"
NO_REASON = "No reason recorded"
NOOPT_UNSERVICEABLE = "No opt-out logged - >=1 med not serviceable"
NOOPT_UNPAID = "No opt-out logged - invoice unpaid"
NOOPT_NO_INVOICE = "No opt-out logged - no invoice"

# per tab: prescribed flag, converted flag, invoice flag, opt-out column,
# serviceability flag (meds only), not-prescribed reason precedence
TAB_SPEC = {
    "meds": ("meds_rx", "meds_conv", "meds_inv", "opt_drug", "meds_all_svc",
             ("meds_noreq", "meds_norx", "meds_norx_fb")),
    "tests": ("tests_rx", "tests_conv", "tests_inv", "opt_lab", None, ("tests_norx",)),
    "therapy": ("ther_rx", "ther_conv", "ther_inv", "opt_ther", None, ("ther_norx",)),
}


def not_prescribed_reason(tab: str) -> Column:
    *_, reasons = TAB_SPEC[tab]
    return F.coalesce(*[F.col(r) for r in reasons], F.lit(NO_REASON))


def not_converted_reason(tab: str) -> Column:
    _, _, inv, opt, svc, _ = TAB_SPEC[tab]
    billing = F.when(F.col(inv) == 1, F.lit(NOOPT_UNPAID)).otherwise(F.lit(NOOPT_NO_INVOICE))
    if svc:
        billing = (F.when(F.col(svc) == 0, F.lit(NOOPT_UNSERVICEABLE))
                   .when(F.col(inv) == 1, F.lit(NOOPT_UNPAID)).otherwise(F.lit(NOOPT_NO_INVOICE)))
    return F.coalesce(F.col(opt), F.col("opt_enc"), billing)


def tab_status(tab: str) -> Column:
    """'cv' | 'nc:<reason>' | 'nr:<reason>' for one tab."""
    rx, conv, *_ = TAB_SPEC[tab]
    return (F.when((F.col(rx) == 1) & (F.col(conv) == 1), F.lit(CONVERTED))
            .when(F.col(rx) == 1, F.concat(F.lit(NOT_CONVERTED), not_converted_reason(tab)))
            .otherwise(F.concat(F.lit(NOT_PRESCRIBED), not_prescribed_reason(tab))))


def eligible() -> Column:
    """A call is eligible if anything of any kind was prescribed."""
    return F.greatest(F.col("meds_rx"), F.col("tests_rx"), F.col("ther_rx"))


def not_eligible_reason() -> Column:
    return F.when(eligible() == 0, F.coalesce(F.col("elig_reason"), F.col("meds_norx_fb"), F.lit(NO_REASON)))


def eligibility(calls: DataFrame) -> DataFrame:
    return calls.select("appt_id", eligible().alias("elig"), not_eligible_reason().alias("ne_reason"))


def tab_grain(calls: DataFrame, tab: str) -> DataFrame:
    """wk, provider_name, ctype, diag, elig, ne_reason, status, n for one tab."""
    return (calls.select(*GRAIN, eligible().alias("elig"), not_eligible_reason().alias("ne_reason"),
                         tab_status(tab).alias("status"))
            .groupBy(*GRAIN, "elig", "ne_reason", "status").agg(F.count(F.lit(1)).alias("n")))


def outcome_kind(status: Column, elig: Column) -> Column:
    return (F.when(elig == 0, F.lit("ne")).when(status == CONVERTED, F.lit("cv"))
            .when(status.startswith(NOT_CONVERTED), F.lit("nc")).otherwise(F.lit("nr")))


def status_long(calls: DataFrame, keep=("appt_id",)) -> DataFrame:
    """All three tabs in one pass: one row per call and tab.

    Adds `tab`, `status`, `kind` (ne / cv / nc / nr) and `reason` (the text after
    the prefix, or the not-eligible reason).
    """
    arr = F.array(*[F.struct(F.lit(t).alias("tab"), tab_status(t).alias("status")) for t in TABS])
    x = calls.select(*keep, eligible().alias("elig"), not_eligible_reason().alias("ne_reason"),
                     F.explode(arr).alias("_s"))
    st = F.col("_s.status")
    kind = outcome_kind(st, F.col("elig"))
    reason = (F.when(kind == "ne", F.col("ne_reason"))
              .when(kind.isin("nc", "nr"), F.substr(st, F.lit(4))))
    return x.select(*keep, "elig", "ne_reason", F.col("_s.tab").alias("tab"), st.alias("status"),
                    kind.alias("kind"), reason.alias("reason"))


def tabs_grain(calls: DataFrame) -> DataFrame:
    """The three tab grains in one aggregate, tagged by `tab`."""
    s = status_long(calls, keep=GRAIN)
    return s.groupBy(*GRAIN, "elig", "ne_reason", "tab", "status").agg(F.count(F.lit(1)).alias("n"))
