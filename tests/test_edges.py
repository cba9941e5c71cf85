"""Hand-written edge rows through the call pipeline (FIXTURES.md §3.3, SURVEY §1.4)."""

import datetime as dt

from pyspark.sql import functions as F

from callfunnel.config import FunnelConfig
from callfunnel.functions import ladders as L
from callfunnel.operators import calls as C
from callfunnel.operators import cells as CE
from callfunnel.operators import funnel as FN
from callfunnel.operators import rollups as R
from callfunnel.operators import status as S
from callfunnel.sources.schema import SCHEMAS
from callfunnel.sources.tables import Tables

CFG = FunnelConfig(appt_start=dt.date(2026, 3, 2), sub_start=dt.date(2026, 2, 1), online_locations=(900,),
                   therapy_id=77)
TS = dt.datetime(2026, 3, 4, 10, 0)
SKIP = L.TITLE_MEDS_SKIP


def tables(spark, **rows) -> Tables:
    dfs = {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()}
    return Tables(**dfs)


def appt(i, patient=1, provider=1, type_id=1, location=None, start=TS, status="COMPLETED"):
    # id, patient_id, provider_id, type_id, location_id, status, start_time, deleted_at
    return (i, patient, provider, type_id, location, status, start, None)


TYPES = [(1, "Screening Call", None), (2, "Follow Up", None), (3, "Patient Queries", None),
         (4, "Report Reading", None)]
PROVS = [(1, "Dr A"), (2, "Dr A"), (3, "Dr B")]


def enc(i, appointment, patient=1, typ="Standard", created=TS):
    return (i, patient, appointment, typ, created, None)


def calls_of(spark, **rows):
    rows.setdefault("call_types", TYPES)
    rows.setdefault("providers", PROVS)
    t = tables(spark, **rows)
    return C.calls_with_diagnosis(t, CFG), t


def one(df, **eq):
    for k, v in eq.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_label_max_is_string_max(spark):
    t = tables(spark, form_answers=[(10, SKIP, "misc", TS, None), (10, SKIP, "Already taking it", TS, None),
                                    (11, L.TITLE_ELIGIBILITY, "Sex Ed talk", TS, None),
                                    (11, L.TITLE_ELIGIBILITY, "Testing done, specialist visit", TS, None)])
    r = {x.encounter_id: x for x in R.reason_pivot(t.form_answers, CFG).collect()}
    assert r[10].meds_norx == "Other"
    assert r[11].elig_reason == "Sex-ed / doubts only"


def test_latest_diagnosis_rules(spark):
    t = tables(spark, encounters=[
        enc(1, 100, patient=7, typ="Merged-RX", created=dt.datetime(2026, 3, 1)),
        enc(2, 101, patient=7, typ="merged-rx", created=dt.datetime(2026, 3, 9)),   # latest, no answer
        enc(3, 102, patient=8, typ="Merged-RX", created=dt.datetime(2026, 3, 9)),
        enc(4, 103, patient=8, typ="Merged-RX", created=None),                       # NULL ranks first
        enc(5, 104, patient=9, typ="Merged-RX", created=TS),
        enc(6, 105, patient=9, typ="Merged-RX", created=TS),                         # tie -> lower id wins
    ], form_answers=[
        (1, "Provisional Diagnosis", "Mental Health Concern", TS, None),
        (4, "Provisional Diagnosis", "Erectile Dysfunction", TS, None),
        (4, "Final diagnosis", "premature ejaculation", TS, None),                   # split terms -> ED+PE+
        (5, "Provisional Diagnosis", "GUI", TS, None),
        (6, "Provisional Diagnosis", "Mental Health Concern", TS, None),
    ])
    d = {r.patient_id: r.diag_cat for r in R.latest_diagnosis(t.encounters, t.form_answers).collect()}
    assert d == {7: "Others", 8: "ED+PE+", 9: "STI"}


def test_call_level_flags(spark):
    calls, _ = calls_of(
        spark,
        appointments=[appt(1), appt(2), appt(3), appt(4, location=None), appt(5, location=900),
                      appt(6, start=dt.datetime(2026, 3, 8, 18, 29)), appt(7, start=dt.datetime(2026, 3, 8, 18, 30)),
                      appt(8, provider=2)],
        encounters=[enc(10, 1), enc(11, 1), enc(20, 2), enc(40, 4), enc(50, 5)],
        drug_orders_src=[(10, 500, "Essentials", TS, None),          # ordered on encounter 10
                         (40, 999, "recommended", TS, None),         # not in inventory, lower-case tier
                         (50, 500, None, TS, None)],
        drug_inventory=[(500, 1)],
        invoices=[(1000, 11, "paid", TS, None),                      # paid on encounter 11, same call
                  (2000, 20, "paid", TS, None),                      # paid without order
                  (3000, 50, None, TS, None)],                       # NULL status ignored
        invoice_items=[(1000, "drug", 500, None), (2000, "drug", 500, None), (3000, "drug", 500, None)],
    )
    c = {r.appt_id: r for r in calls.collect()}
    assert c[1].meds_rx == 1 and c[1].meds_conv == 1                   # order on A, paid on B
    assert c[2].meds_rx == 0 and c[2].meds_conv == 1                   # paid without order
    assert c[3].meds_rx == 0 and c[3].meds_all_svc == 1 and c[3].meds_conv == 0   # no encounter
    assert c[4].meds_all_svc == 0 and c[4].m_ess == 1 and c[4].m_rec == 0          # 'recommended' is essential
    assert c[4].ctype == "Offline SC" and c[5].ctype == "Online SC"
    assert c[5].meds_inv == 0                                          # NULL-status invoice ignored
    assert c[6].wk == "2026-03-02" and c[7].wk == "2026-03-09"          # 18:29 vs 18:30 UTC Sunday
    st = {r.appt_id: r.status for r in S.status_long(calls).filter(F.col("tab") == "meds").collect()}
    assert st[1] == "cv"
    assert st[2] == "nr:No reason recorded"
    assert st[4] == "nc:No opt-out logged - >=1 med not serviceable"
    el = {r.appt_id: (r.elig, r.ne_reason) for r in S.eligibility(calls).collect()}
    assert el[3] == (0, "No reason recorded")
    fg = FN.funnel_grain(calls).agg(F.sum("m_cv").alias("cv"), F.sum("m_rx").alias("rx")).first()
    assert fg.cv <= fg.rx
    # namesake providers share one cell
    cells = CE.grain_cells(S.tabs_grain(calls))
    names = {r.provider_name for r in cells.collect()}
    assert names == {"Dr A"}


def test_soft_deleted_and_pre_cushion_rows_change_nothing(spark):
    base = dict(appointments=[appt(1)], encounters=[enc(10, 1)],
                therapy_orders_src=[(10, 77, 2, 1, "Recommended", TS, None)])
    extra = dict(base)
    extra["therapy_orders_src"] = base["therapy_orders_src"] + [
        (10, 77, 2, 2, None, TS, TS),                                  # soft-deleted
        (10, 77, 2, 2, None, dt.datetime(2025, 1, 1), None)]           # before the cushion
    extra["appointments"] = base["appointments"] + [appt(2, status="CANCELLED"), (3, 1, 1, 1, None, "COMPLETED",
                                                                                 TS, TS)]
    a, _ = calls_of(spark, **base)
    b, _ = calls_of(spark, **extra)
    assert sorted(a.collect()) == sorted(b.collect())
    r = a.first()
    assert (r.ther_rx, r.ther_conv, r.th_rec, r.th_ess) == (1, 1, 1, 0)


def test_envelope_keeps_first_tab_on_ties(spark):
    cells = spark.createDataFrame(
        [("2026-03-02", "Dr A", "FU", "Others", t, 5, 3, 2, 1, 1, 1, 2) for t in S.TABS],
        "wk string, provider_name string, ctype string, diag string, tab string, calls long, elig long, "
        "rx long, cv long, nc long, nr long, ne long")
    assert CE.cell_envelope(cells).first().ne_tab == "meds"


def test_skew_free_rewrite_matches_literal_join_order(spark):
    """calls -> encounters -> rollups GROUP BY call, written literally, equals build_calls."""
    calls, t = calls_of(
        spark, appointments=[appt(1), appt(2), appt(3)], encounters=[enc(10, 1), enc(11, 1), enc(20, 2)],
        drug_orders_src=[(10, 500, "Recommended", TS, None), (20, 501, None, TS, None)],
        lab_orders_src=[(11, 7, None, TS, None)],
        preferences=[(11, "drug", 1, "budget issue", TS, None), (10, "encounter", 1, None, TS, None)],
        form_answers=[(20, L.TITLE_TESTS, "done already", TS, None)])
    roll = C.encounter_rollups(t, CFG, coded=False)
    base = C.call_base(t.appointments, t.call_types, t.providers, CFG)
    e = t.encounters.select(F.col("id").alias("eid"), "appointment_id")
    lit = base.join(e, base.appt_id == e.appointment_id, "left")
    d = roll["drug"].select(F.col("encounter_id").alias("d_e"))
    o = roll["optout"].select(F.col("encounter_id").alias("o_e"), "opt_drug", "opt_enc")
    r = roll["reasons"].select(F.col("encounter_id").alias("r_e"), "tests_norx")
    lit = (lit.join(d, lit.eid == d.d_e, "left").join(o, lit.eid == o.o_e, "left")
           .join(r, lit.eid == r.r_e, "left")
           .groupBy("appt_id").agg(F.max(F.when(F.col("d_e").isNotNull(), 1).otherwise(0)).alias("meds_rx"),
                                   F.max("opt_drug").alias("opt_drug"), F.max("opt_enc").alias("opt_enc"),
                                   F.max("tests_norx").alias("tests_norx")))
    want = sorted(tuple(x) for x in lit.select("appt_id", "meds_rx", "opt_drug", "opt_enc", "tests_norx").collect())
    got = sorted(tuple(x) for x in calls.select("appt_id", "meds_rx", "opt_drug", "opt_enc", "tests_norx").collect())
    assert got == want
    assert dict((r[0], r[2]) for r in got)[1] == "Budget / price"


def test_call_keys_group_repeated_dimension_and_appointment_rows(spark):
    """The call table has the rows of GROUP BY the five call keys, whatever is listed twice."""
    calls, t = calls_of(
        spark, appointments=[appt(1), appt(1), appt(2), appt(2, patient=5)], encounters=[enc(10, 1), enc(20, 2)],
        providers=[(1, "Dr A"), (1, "Dr A"), (1, "Dr Other")], call_types=[*TYPES, TYPES[0]],
        drug_orders_src=[(10, 500, "Essentials", TS, None)])
    got = sorted(tuple(r) for r in calls.select(*C.CALL_KEYS, "meds_rx").collect())
    wk = "2026-03-02"
    assert got == sorted((a, p, wk, n, "Offline SC", rx) for a, p, rx in ((1, 1, 1), (2, 1, 0), (2, 5, 0)) for n in ("Dr A", "Dr Other"))


def test_a_hot_patient_and_calls_without_one(spark):
    calls, _ = calls_of(spark, appointments=[appt(i, patient=None if i % 3 else 7) for i in range(1, 61)],
                        encounters=[enc(1000, None, patient=7, typ="Merged-RX"), enc(1001, None, patient=None, typ="Merged-RX")],
                        form_answers=[(1000, "Diagnosis", "GUI", TS, None), (1001, "Diagnosis", "GUI", TS, None)])
    got = {r.appt_id: r.diag for r in calls.collect()}
    assert got == {i: "Others" if i % 3 else "STI" for i in range(1, 61)}


def test_an_item_listed_many_times_on_an_invoice(spark):
    t = tables(spark, invoices=[(1, 10, "paid", TS, None)], invoice_items=[(1, "drug", 500, None)] * 50 + [(None, "drug", 500, None)] * 50)
    assert [tuple(r) for r in R.paid_items(t.invoices, t.invoice_items, CFG).collect()] == [(10, "drug", 500)]


def test_ordered_concat(spark):
    """Texts in order, NULLs left out, a hot group and one of NULLs only; whatever the batches."""
    rows = [(1, f"t{i:05d}") for i in range(5000)] + [(2, None), (3, "b"), (3, "a"), (3, None), (3, "é"), (None, "z"), (None, "y"), (4, ""), (4, "x")]
    df = spark.createDataFrame(rows, "k long, t string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = [tuple(r) for r in R.ordered_concat(df, "k", "t", "t", "all").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 5 and dict(got) == {1: ",".join(f"t{i:05d}" for i in range(5000)), 2: None, 3: "a,b,é", None: "y,z", 4: ",x"}
    assert R.ordered_concat(df.limit(0), "k", "t", "t", "all").collect() == []


def test_ladder_with_a_pattern_that_holds_the_separator(spark):
    ladder = L.Ladder("x", ((L.Has("a,b"), "both"), (L.Has("c"), "c")), "none")
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (2, "a"), (3, None), (4, "A,B")], "k long, t string")
    got = {r.k: r.label for r in R.ladder_over_groups(df, "k", "t", ladder, "label").collect()}
    assert got == {1: "both", 2: "c", 3: "none", 4: "both"}


def test_diagnosis_text_and_label_agree_with_the_flags(spark):
    t = tables(spark, encounters=[enc(i, i, typ="Merged-RX") for i in range(4)], form_answers=[
        (0, "Diagnosis", "zeta", TS, None), (0, "final diagnosis", "alpha", TS, None), (1, "Diagnosis", None, TS, None), (2, "Other", "x", TS, None),
        (3, "Diagnosis", "gone", TS, TS)])
    got = {r.encounter_id: (r.diagnosis, r.diag_cat) for r in R.diagnosis_texts(t.encounters, t.form_answers).collect()}
    flags = {r.encounter_id: r.diag_cat for r in R.diagnosis_per_encounter(t.encounters, t.form_answers).collect()}
    assert {k: v[0] for k, v in got.items()} == {0: "alpha,zeta", 1: None, 2: None, 3: None}
    assert {k: v[1] for k, v in got.items()} == flags


def test_a_filter_is_a_lookup_in_the_cube(spark):
    rows = [(f"2025-01-0{6 + i % 2}", p, c, d, t, *[i + k for k in range(7)])
            for i, (p, c, d, t) in enumerate((p, c, d, t) for p in ("A", "B", None) for c in ("x", "y") for d in ("STI", None) for t in ("meds", "tests"))]
    cells = spark.createDataFrame(rows, "wk string, provider_name string, ctype string, diag string, tab string, " + ", ".join(f"{c} long" for c in CE.COUNTS))
    cube = CE.filter_cube(cells)
    for chosen in ({}, {"providers": ["A"]}, {"providers": ["A", "B"], "diags": ["STI"]}, {"ctypes": ["x"]},
                   {"providers": ["B"], "ctypes": ["y", "x"], "diags": ["STI"]}, {"providers": ["nobody"]}):
        want = sorted(map(str, CE.weekly_filtered(cells, **chosen).collect()))
        assert sorted(map(str, CE.weekly_from_cube(cube, **chosen).collect())) == want
    # a missing name is a value of its own, not an open filter
    assert cube.filter("level = 3 AND provider_name IS NULL").count() == cells.filter("provider_name IS NULL").select("wk", "tab").distinct().count()
