"""Registered queries: one per operator, each a function (spark, sf_dir) -> DataFrame.

Domain operators run on the adapter views of the driver tables (FIXTURES.md);
generic operators (ladders, week buckets, latest-per-key, predicates) run
straight on `documents` and `events`. Every query reads whole tables.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callfunnel.config import FunnelConfig
from callfunnel.functions import ladders as L
from callfunnel.functions.predicates import flag, live, local_since, since
from callfunnel.functions.timefns import run_stamp as stamp_col
from callfunnel.functions.timefns import week_label
from callfunnel.operators import calls as C
from callfunnel.operators import cells as CE
from callfunnel.operators import checks as Q
from callfunnel.operators import encode as E
from callfunnel.operators import funnel as FN
from callfunnel.operators import rollups as R
from callfunnel.operators import status as S
from callfunnel.sources import publish as P
from callfunnel.session import materialize
from callfunnel.sources.adapters import ADAPTER_CONFIG, adapter_tables, read_driver
from callfunnel.sources.fixture_text import PROBES

TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_FMT_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_str(c, fmt: str = TS_FMT):
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)


class Ctx:
    """Lazily built DataFrames of one (session, sf_dir) pair."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: FunnelConfig = ADAPTER_CONFIG):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self.t = adapter_tables(spark, sf_dir)
        self._memo = {}

    def memo(self, key, fn):
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    def driver(self, name: str) -> DataFrame:
        return read_driver(self.spark, self.sf_dir, name)

    @property
    def rollups(self):
        return self.memo("rollups", lambda: C.encounter_rollups(self.t, self.cfg))

    @property
    def calls(self):
        return self.memo("calls", lambda: C.build_calls(self.t, self.cfg, self.rollups))

    @property
    def diag(self):
        return self.memo("diag", lambda: R.latest_diagnosis(self.t.encounters, self.t.form_answers))

    @property
    def calls_dx(self):
        return self.memo("calls_dx", lambda: C.attach_diagnosis(self.calls, self.diag))

    @property
    def tabs(self):
        return self.memo("tabs", lambda: S.tabs_grain(self.calls_dx))

    @property
    def cells(self):
        return self.memo("cells", lambda: CE.grain_cells(self.tabs))

    @property
    def reasons(self):
        return self.memo("reasons", lambda: CE.grain_reason_counts(self.tabs))

    @property
    def funnel(self):
        return self.memo("funnel", lambda: FN.funnel_grain(self.calls_dx))


_CTX: dict = {}


def ctx(spark: SparkSession, sf_dir: str) -> Ctx:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CTX:
        _CTX.clear()
        _CTX[key] = Ctx(spark, sf_dir)
    return _CTX[key]


def q(fn: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ctx(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---------------------------------------------------------------- generic: ladders on documents
def _ladder_on_documents(ladder: L.Ladder):
    def f(c: Ctx) -> DataFrame:
        # every document's whole text, and beside it a short answer: one of the ladder's probes by id,
        # which between them hold every alternative pattern of every rung
        probes = F.expr("array(" + ", ".join("CAST(NULL AS STRING)" if p is None else L.spark_str(p) for p in PROBES[ladder.name]) + ")")
        answer = F.get(probes, F.pmod("doc_id", F.lit(len(PROBES[ladder.name]))).cast("int"))
        texts = F.array(F.struct(F.lit("document").alias("part"), F.col("text").alias("text")),
                        F.struct(F.lit("answer").alias("part"), answer.alias("text")))
        # lower(text) is projected once and shared by every rung of the ladder
        d = (c.driver("documents").select("doc_id", F.explode(texts).alias("_t"))
             .select("doc_id", "_t.part", "_t.text", F.lower("_t.text").alias("_lv")))
        return d.select("doc_id", "part", L.ladder_column(ladder, "text", "_lv").alias("label"))
    f.__name__ = f"ladder_{ladder.name}"
    return f


def pred_ilike(c: Ctx) -> DataFrame:
    d = c.driver("documents").select("doc_id", F.lower("text").alias("_lv"))
    tests = {"has_later": "later", "has_the": "the ", "has_dont_want": "don%want", "has_on_the": "on%the"}
    return d.select("doc_id", *[flag(L.has_pattern(p, "_lv")).alias(name) for name, p in tests.items()])


def week_bucket(c: Ctx) -> DataFrame:
    e = c.driver("events")
    return e.select("event_id", week_label("ts", c.cfg.shift_hours, c.cfg.shift_minutes).alias("wk"))


def latest_per_key(c: Ctx) -> DataFrame:
    e = c.driver("events").select("user_id", "event_id", "event_type", "ts")
    top = R.latest_per_key(e, "user_id", [F.col("ts").desc_nulls_first(), F.col("event_id").asc_nulls_last()])
    return top.select("user_id", "event_id", "event_type", ts_str("ts", TS_FMT_US).alias("ts"))


# ---------------------------------------------------------------- filters
def filter_live(c: Ctx) -> DataFrame:
    return live(c.t.encounters).select("id", "appointment_id", "type", ts_str("created_at").alias("created_at"))


def filter_since(c: Ctx) -> DataFrame:
    return since(c.t.drug_orders_src, c.cfg.sub_start).select(
        "encounter_id", "drug_id", "importance_level", ts_str("created_at").alias("created_at"))


def filter_local_since(c: Ctx) -> DataFrame:
    a = local_since(c.t.appointments, c.cfg.appt_start, "start_time", c.cfg.shift_hours, c.cfg.shift_minutes)
    return a.select("id", ts_str("start_time").alias("start_time"))


def filter_membership(c: Ctx) -> DataFrame:
    a = c.t.appointments
    return a.filter(F.col("status").isin(*L.CALL_STATUSES) & F.col("location_id").isin(*c.cfg.online_locations)) \
            .select("id", "status", "location_id")


def filter_not_cancelled(c: Ctx) -> DataFrame:
    return c.t.invoices.filter(F.col("status") != "cancelled").select("id", "encounter_id", "status")


# ---------------------------------------------------------------- rollups and joins
def paid_items_distinct(c: Ctx) -> DataFrame:
    return R.paid_items(c.t.invoices, c.t.invoice_items, c.cfg)


def join_paid_items(c: Ctx) -> DataFrame:
    o = since(live(c.t.drug_orders_src), c.cfg.sub_start)
    p = (R.paid_items(c.t.invoices, c.t.invoice_items, c.cfg).filter(F.col("type") == "drug")
         .select(F.col("encounter_id").alias("_e"), F.col("type_id").alias("_t"), F.lit(1).alias("_p")))
    j = o.join(p, (o.encounter_id == p._e) & (o.drug_id == p._t), "left")
    return j.select("encounter_id", "drug_id", "importance_level",
                    F.coalesce(F.col("_p"), F.lit(0)).alias("paid"))


def drug_rollup(c: Ctx) -> DataFrame:
    return c.rollups["drug"]


def lab_rollup(c: Ctx) -> DataFrame:
    return c.rollups["lab"]


def therapy_rollup(c: Ctx) -> DataFrame:
    return c.rollups["ther"]


def invoice_flags(c: Ctx) -> DataFrame:
    return c.rollups["inv"]


def reason_pivot(c: Ctx) -> DataFrame:
    return R.decode_labels(c.rollups["reasons"], R.REASON_COLUMNS)


def recommendation_flags(c: Ctx) -> DataFrame:
    return c.rollups["dss"]


def optout_pivot(c: Ctx) -> DataFrame:
    return R.decode_labels(c.rollups["optout"], R.OPTOUT_COLUMNS)


def text_concat_per_key(c: Ctx) -> DataFrame:
    """Joined diagnosis answers of each merged-rx encounter, and the label of that text."""
    return R.diagnosis_texts(c.t.encounters, c.t.form_answers)


def latest_diagnosis(c: Ctx) -> DataFrame:
    return c.diag


def call_base(c: Ctx) -> DataFrame:
    return C.call_base(c.t.appointments, c.t.call_types, c.t.providers, c.cfg)


def call_type(c: Ctx) -> DataFrame:
    return call_base(c).select("appt_id", "ctype")


def join_call_dims(c: Ctx) -> DataFrame:
    d = C.call_dims(c.t.appointments, c.t.call_types, c.t.providers, c.cfg)
    return d.select(F.col("id").alias("appt_id"), "type_name", "provider_name", "location_id")


def join_presence_flags(c: Ctx) -> DataFrame:
    """Per encounter of a call: which of the seven rollups had a row for it."""
    e = C.encounter_flags(c.t.encounters, c.rollups, c.cfg)
    marks = (("drug", "d_present"), ("lab", "l_present"), ("ther", "t_present"), ("inv", "inv_present"),
             ("reasons", "reasons_present"), ("optout", "optout_present"), ("dss", "dss_present"))
    return e.select("encounter_id", "appointment_id",
                    *[F.coalesce(F.col(m), F.lit(0)).alias(f"has_{k}") for k, m in marks])


def call_rollup(c: Ctx) -> DataFrame:
    return c.calls


def join_latest_diag(c: Ctx) -> DataFrame:
    return c.calls_dx.select("appt_id", "patient_id", "diag")


# ---------------------------------------------------------------- status, tabs, funnel
def eligibility(c: Ctx) -> DataFrame:
    return S.eligibility(c.calls)


def status_long(c: Ctx) -> DataFrame:
    return S.status_long(c.calls).select("appt_id", "tab", "status", "kind", "reason")


def _tab(tab: str):
    def f(c: Ctx) -> DataFrame:
        return S.tab_grain(c.calls_dx, tab)
    f.__name__ = f"tab_{tab}"
    return f


def funnel_grain(c: Ctx) -> DataFrame:
    return c.funnel


def funnel_cells(c: Ctx) -> DataFrame:
    return FN.funnel_cells(c.funnel)


def funnel_reason_counts(c: Ctx) -> DataFrame:
    return FN.funnel_reason_counts(c.funnel)


# ---------------------------------------------------------------- cells and metrics
def grain_cells(c: Ctx) -> DataFrame:
    return c.cells


def grain_reason_counts(c: Ctx) -> DataFrame:
    return c.reasons


def cell_envelope(c: Ctx) -> DataFrame:
    return CE.cell_envelope(c.cells)


def reconcile_totals(c: Ctx) -> DataFrame:
    return CE.reconcile_totals(c.tabs)


def weekly_metrics(c: Ctx) -> DataFrame:
    return CE.weekly_metrics(c.cells)


WEEKLY_FILTER = {"ctypes": ("Online SC", "Offline SC"), "diags": ("Others", "STI", "MH")}


def weekly_filtered(c: Ctx) -> DataFrame:
    return CE.weekly_filtered(c.cells, **WEEKLY_FILTER)


def filter_cube(c: Ctx) -> DataFrame:
    return CE.filter_cube(c.cells)


def reason_breakdown(c: Ctx) -> DataFrame:
    return CE.reason_breakdown(c.reasons)


# ---------------------------------------------------------------- encoding and publish
def dim_weeks(c: Ctx) -> DataFrame:
    return E.dim_positions(c.cells, "wk", "wk_ix")


def dim_providers(c: Ctx) -> DataFrame:
    return E.spread_positions(c.cells, "provider_name", "provider_ix")


def dim_ctype(c: Ctx) -> DataFrame:
    return E.fixed_positions(c.cells, "ctype", L.CTYPE_ORDER, "ctype_ix")


def dim_diag(c: Ctx) -> DataFrame:
    return E.fixed_positions(c.cells, "diag", L.DIAG_ORDER, "diag_ix")


def reason_dictionary(c: Ctx) -> DataFrame:
    return E.reason_dictionary(c.reasons, FN.funnel_reason_counts(c.funnel))


def reasons_ranked(c: Ctx) -> DataFrame:
    return E.reasons_ranked(c.reasons)


def _encoded(c: Ctx):
    def build():
        # the call table once, then the grains and cells from it, as a refresh does
        calls = materialize(c.calls_dx, "calls")
        cells = materialize(CE.grain_cells(tabs := materialize(S.tabs_grain(calls), "tabs")), "cells")
        reasons = materialize(CE.grain_reason_counts(tabs), "reasons")
        return P.encode_outputs(cells, reasons, materialize(FN.funnel_grain(calls), "funnel"))
    return c.memo("encoded", build)


def publish_rows(c: Ctx) -> DataFrame:
    """The published rows, decoded: wk, provider_name, ctype, diag, tab, kind, reason, n."""
    return P.decode_rows(_encoded(c))


def publish_er(c: Ctx) -> DataFrame:
    """The published funnel rows, decoded: wk, provider_name, ctype, diag, comp, measure, reason, n."""
    return P.decode_er(_encoded(c))


def publish_doc(c: Ctx) -> DataFrame:
    """The document's lines by section: how many, how many open with a comma, and the elements' sum of calls or positions."""
    enc = _encoded(c)  # its rows are written before the document is built, as `publish` does
    written = c.memo("written", lambda: replace(enc, rows=materialize(enc.rows, "rows"), er=materialize(enc.er, "er")))
    lines = P.document_lines(written, updated=run_stamp(c).select("updated"))
    element = F.when(F.col("line").startswith(","), F.substr("line", F.lit(2))).otherwise(F.col("line"))
    calls = F.get_json_object(element, "$[4]").cast("bigint")
    body = F.col("section").isin(P.SECTIONS.index("rows"), P.SECTIONS.index("er"))
    names = F.array(*[F.lit(s) for s in P.SECTIONS])
    return (lines.filter("part = 1").select(
        F.get(names, F.col("section")).alias("section"), F.when(F.col("line").startswith(","), 1).otherwise(0).alias("comma"),
        F.when(body, calls).otherwise(F.col("wk_ix")).alias("v"))
        .groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.sum("comma").alias("n_commas"), F.sum("v").alias("total")))


def run_stamp(c: Ctx) -> DataFrame:
    """Stamp of the newest completed call in the data (the run's 'as of')."""
    d = C.call_dims(c.t.appointments, c.t.call_types, c.t.providers, c.cfg)
    return d.agg(F.max("start_time").alias("_as_of")).select(
        ts_str("_as_of").alias("as_of"),
        stamp_col("_as_of", c.cfg.shift_hours, c.cfg.shift_minutes).alias("updated"))


def protect_roundtrip(c: Ctx) -> DataFrame:
    # a round trip keeps nothing, so a secret of its own will do
    return P.protect_roundtrip(c.cells, P.derive_key(secrets.token_urlsafe(24)))


def unique_keys_audit(c: Ctx) -> DataFrame:
    names = {"drug": "drug_rollup", "lab": "lab_rollup", "ther": "therapy_rollup", "inv": "invoice_flags",
             "reasons": "reason_pivot", "optout": "optout_pivot", "dss": "recommendation_flags"}
    rel = {names[k]: (df, "encounter_id") for k, df in c.rollups.items()}
    rel["calls"] = (c.calls, "appt_id")
    rel["latest_diagnosis"] = (c.diag, "patient_id")
    return Q.unique_keys_audit(rel)


# ---------------------------------------------------------------- registry
_FUNCS = [
    *[_ladder_on_documents(lad) for lad in L.ALL_LADDERS.values()],
    pred_ilike, week_bucket, latest_per_key,
    filter_live, filter_since, filter_local_since, filter_membership, filter_not_cancelled,
    paid_items_distinct, join_paid_items, drug_rollup, lab_rollup, therapy_rollup, invoice_flags,
    reason_pivot, recommendation_flags, optout_pivot, text_concat_per_key, latest_diagnosis,
    call_base, call_type, join_call_dims, join_presence_flags, call_rollup, join_latest_diag,
    eligibility, status_long, *[_tab(t) for t in S.TABS], funnel_grain, funnel_cells, funnel_reason_counts,
    grain_cells, grain_reason_counts, cell_envelope, reconcile_totals, weekly_metrics, weekly_filtered,
    filter_cube, reason_breakdown, dim_weeks, dim_providers, dim_ctype, dim_diag, reason_dictionary, reasons_ranked,
    publish_rows, publish_er, publish_doc, run_stamp, protect_roundtrip, unique_keys_audit,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: q(f) for f in _FUNCS}
