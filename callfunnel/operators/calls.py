"""Call assembly: one row per completed call with 29 flags and reasons.

Which ordered items were paid (`ess_paid`, `rec_paid`) stays with the item
rollups: no call-level output reads it, so the call table does without the
invoice-item joins behind it.

Plan (skew-free rewrite of "calls LEFT JOIN encounters LEFT JOIN 7 rollups
GROUP BY call"):

1. encounters (live, in cushion, with an appointment) LEFT JOIN each rollup on
   encounter_id. Every rollup is already hash-partitioned on encounter_id by its
   own aggregate, so only the encounter list is shuffled for these joins.
2. GROUP BY appointment_id with MIN/MAX (map-side combinable).
3. calls LEFT JOIN that on appt_id, defaults filled: flags 0, all_svc 1.

Calls without an encounter never meet a NULL join key (the literal plan would
send all of them, with a NULL encounter id, through seven joins on one
reducer). All aggregates are MIN/MAX, so regrouping by appointment first gives
the same values, including the per-flag independence across encounters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfunnel.config import FunnelConfig
from callfunnel.functions import ladders as L
from callfunnel.functions.predicates import live, local_since, since
from callfunnel.functions.timefns import week_label
from callfunnel.operators import rollups as R

ENC = R.ENC
CALL_KEYS = ("appt_id", "patient_id", "wk", "provider_name", "ctype")

# (output column, per-encounter expression source, aggregate, default when no encounter)
INT_FLAGS = (
    ("meds_rx", "d_present", "max", 0),
    ("meds_conv", "drug_paid", "max", 0),
    ("meds_all_svc", "all_svc", "min", 1),
    ("meds_inv", "drug_inv", "max", 0),
    ("tests_rx", "l_present", "max", 0),
    ("tests_conv", "lab_paid", "max", 0),
    ("tests_inv", "lab_inv", "max", 0),
    ("ther_rx", "t_present", "max", 0),
    ("ther_conv", "ther_conv_e", "max", 0),
    ("ther_inv", "ther_inv", "max", 0),
    ("m_ess", "d_has_ess", "max", 0), ("m_rec", "d_has_rec", "max", 0),
    ("t_ess", "l_has_ess", "max", 0), ("t_rec", "l_has_rec", "max", 0),
    ("th_ess", "t_has_ess", "max", 0), ("th_rec", "t_has_rec", "max", 0),
    ("m_dss", "dss_drug", "max", 0),
    ("t_dss", "dss_lab", "max", 0),
    ("th_dss", "dss_ther", "max", 0),
)
TEXT_COLS = ("meds_norx", "meds_noreq", "meds_norx_fb", "elig_reason", "tests_norx", "ther_norx",
             "opt_drug", "opt_lab", "opt_ther", "opt_enc")
CALL_COLUMNS = CALL_KEYS + tuple(c for c, *_ in INT_FLAGS) + TEXT_COLS


def call_dims(appointments: DataFrame, call_types: DataFrame, providers: DataFrame,
              cfg: FunnelConfig) -> DataFrame:
    """Completed calls in range joined to their (live) type name and provider name."""
    a = (local_since(live(appointments), cfg.appt_start, "start_time", cfg.shift_hours, cfg.shift_minutes)
         .filter(F.col("status").isin(*L.CALL_STATUSES))
         .select("id", "patient_id", "provider_id", "type_id", "location_id", "start_time"))
    # a dimension row that is listed twice counts once; AQE picks the join by measured size
    types = (live(call_types).filter(F.col("name").isin(*L.CALL_TYPE_NAMES))
             .select(F.col("id").alias("_tid"), F.col("name").alias("type_name")).distinct())
    provs = providers.select(F.col("id").alias("_pid"), F.col("name").alias("provider_name")).distinct()
    return (a.join(types, a.type_id == F.col("_tid"), "inner")
            .join(provs, a.provider_id == F.col("_pid"), "inner")
            .drop("_tid", "_pid"))


def call_base(appointments: DataFrame, call_types: DataFrame, providers: DataFrame,
              cfg: FunnelConfig) -> DataFrame:
    """appt_id, patient_id, wk (local Monday, yyyy-MM-dd), provider_name, ctype."""
    d = call_dims(appointments, call_types, providers, cfg)
    base = d.select(
        F.col("id").alias("appt_id"), "patient_id",
        week_label("start_time", cfg.shift_hours, cfg.shift_minutes).alias("wk"),
        "provider_name",
        L.call_type_column("type_name", "location_id", cfg.online_locations).alias("ctype"))
    # one row per distinct call key; dealt by appt_id, which the flags are joined on next
    return base.repartition("appt_id").dropDuplicates(list(CALL_KEYS))


def encounter_rollups(t, cfg: FunnelConfig, coded: bool = True) -> dict[str, DataFrame]:
    """The seven per-encounter rollups over a `Tables` bundle (labels as codes by default)."""
    paid = R.paid_items(t.invoices, t.invoice_items, cfg)
    return {
        "drug": R.drug_rollup(t.drug_orders_src, t.drug_inventory, paid, cfg),
        "lab": R.lab_rollup(t.lab_orders_src, paid, cfg),
        "ther": R.therapy_rollup(t.therapy_orders_src, cfg),
        "inv": R.invoice_flags(t.invoices, t.invoice_items, cfg),
        "reasons": R.reason_pivot(t.form_answers, cfg, coded=coded),
        "optout": R.optout_pivot(t.preferences, cfg, coded=coded),
        "dss": R.recommendation_flags(t.encounter_tags, cfg),
    }


def encounter_flags(encounters: DataFrame, rollups: dict[str, DataFrame], cfg: FunnelConfig) -> DataFrame:
    """One row per live in-cushion encounter that belongs to an appointment."""
    e = (since(live(encounters), cfg.sub_start).filter(F.col("appointment_id").isNotNull())
         .select(F.col("id").alias(ENC), "appointment_id"))
    d = rollups["drug"].select(ENC, F.lit(1).alias("d_present"), "all_svc",
                               *[F.col(c).alias("d_" + c) for c in ("has_rec", "has_ess")])
    lb = rollups["lab"].select(ENC, F.lit(1).alias("l_present"),
                               *[F.col(c).alias("l_" + c) for c in ("has_rec", "has_ess")])
    th = rollups["ther"].select(ENC, F.lit(1).alias("t_present"), F.col("consumed").alias("t_consumed"),
                                *[F.col(c).alias("t_" + c) for c in ("has_rec", "has_ess")])
    marked = {k: rollups[k].withColumn(f"{k}_present", F.lit(1)) for k in ("inv", "reasons", "optout", "dss")}
    j = (e.join(d, ENC, "left").join(lb, ENC, "left").join(th, ENC, "left")
         .join(marked["inv"], ENC, "left").join(marked["reasons"], ENC, "left")
         .join(marked["optout"], ENC, "left").join(marked["dss"], ENC, "left"))
    return j.withColumn("ther_conv_e", F.greatest(F.coalesce(F.col("t_consumed"), F.lit(0)),
                                                  F.coalesce(F.col("ther_paid"), F.lit(0))))


def flags_per_call(enc_flags: DataFrame) -> DataFrame:
    aggs = []
    for out, src, how, default in INT_FLAGS:
        c = F.coalesce(F.col(src), F.lit(default))
        aggs.append((F.min(c) if how == "min" else F.max(c)).alias(out))
    aggs += [F.max(c).alias(c) for c in TEXT_COLS]
    return enc_flags.groupBy("appointment_id").agg(*aggs)


def call_rollup(base: DataFrame, per_call: DataFrame) -> DataFrame:
    """One row per call: base columns + flags (defaults for calls without encounters)."""
    j = base.join(per_call, base.appt_id == per_call.appointment_id, "left")
    cols = [F.col(k) for k in CALL_KEYS]
    cols += [F.coalesce(F.col(out), F.lit(default)).alias(out) for out, _, _, default in INT_FLAGS]
    cols += [L.decode_label(R.LABEL_LADDERS[c], c).alias(c) for c in TEXT_COLS]
    return j.select(*cols)


def build_calls(t, cfg: FunnelConfig, rollups: dict[str, DataFrame] | None = None) -> DataFrame:
    """Full call table (without diagnosis) from a `Tables` bundle (rollups with coded labels)."""
    rollups = rollups or encounter_rollups(t, cfg, coded=True)
    base = call_base(t.appointments, t.call_types, t.providers, cfg)
    return call_rollup(base, flags_per_call(encounter_flags(t.encounters, rollups, cfg)))


def attach_diagnosis(calls: DataFrame, diag: DataFrame, out: str = "diag") -> DataFrame:
    """Calls LEFT JOIN the patient's latest diagnosis; no diagnosis -> ELSE label.

    Calls without a patient can't match and would all go to one task: they are dealt
    out by their call id instead. AQE splits the partition of a patient with very many calls.
    """
    d = diag.filter(F.col("patient_id").isNotNull()).select(
        F.lit(False).alias("_dnone"), F.col("patient_id").alias("_dpat"), F.col("diag_cat").alias("_dcat"))
    c = calls.withColumn("_none", F.col("patient_id").isNull()).withColumn("_key", F.coalesce("patient_id", "appt_id"))
    return (c.join(d, (c._none == d._dnone) & (c._key == d._dpat), "left")
            .withColumn(out, F.coalesce(F.col("_dcat"), F.lit(L.DIAGNOSIS.otherwise)))
            .drop("_none", "_key", "_dnone", "_dpat", "_dcat"))


def calls_with_diagnosis(t, cfg: FunnelConfig) -> DataFrame:
    calls = build_calls(t, cfg)
    return attach_diagnosis(calls, R.latest_diagnosis(t.encounters, t.form_answers))
