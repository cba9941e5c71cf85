"""Properties of the composed pipeline on the driver tables, and the oracle gate."""

import json
import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from callfunnel.operators import cells as CE
from callfunnel.operators import encode as E
from callfunnel.operators import funnel as FN
from callfunnel.plans import queries as Q
from callfunnel.plans.refresh import check_totals, publish, refresh
from callfunnel.sources import publish as P
from callfunnel.sources.adapters import ADAPTER_CONFIG, adapter_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def out(spark):
    return refresh(spark, adapter_tables(spark, SF), ADAPTER_CONFIG)


def test_funnel_identities(out):
    f = out.funnel
    for p in FN.COMPONENTS:
        bad = f.filter((F.col(f"{p}_ae") + F.col(f"{p}_er") + F.col(f"{p}_or") != F.col(f"{p}_rx"))
                       | (F.col(f"{p}_ae_cv") + F.col(f"{p}_er_cv") + F.col(f"{p}_or_cv") != F.col(f"{p}_cv"))
                       | (F.col(f"{p}_dss_cv") + F.col(f"{p}_nodss_cv") != F.col(f"{p}_cv"))
                       | (F.col(f"{p}_dss") - F.col(f"{p}_dss_norx") + F.col(f"{p}_nodss_rx") != F.col(f"{p}_rx")))
        assert bad.count() == 0, p


def test_totals_reconcile(out):
    assert check_totals(out) == "ok"
    n_calls = out.calls.count()
    tot = out.totals.first()
    assert tot.meds_total == tot.tests_total == tot.therapy_total == n_calls
    assert out.calls.select("appt_id").distinct().count() == n_calls
    assert out.cells.filter(F.col("cv") + F.col("nc") + F.col("nr") + F.col("ne") != F.col("calls")).count() == 0
    assert out.funnel.agg(F.sum("n")).first()[0] == n_calls


def test_partition_count_does_not_change_results(spark, out):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = refresh(spark, adapter_tables(spark, SF), ADAPTER_CONFIG)
        assert sorted(other.cells.collect()) == sorted(out.cells.collect())
        assert sorted(other.encoded.providers.collect()) == sorted(out.encoded.providers.collect())
        other.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _document(file: str) -> dict:
    text = open(file).read()
    assert text.startswith("window.X = ") and text.endswith("};\n")
    return json.loads(text.strip()[len("window.X = "):-1])


@pytest.fixture(scope="module")
def updated(spark):
    return spark.createDataFrame([("01 Mar 2026, 10:00 IST",)], "updated string")


def test_document_is_json_and_decodes_to_cells(spark, out, updated):
    d = tempfile.mkdtemp(prefix="callfunnel-doc-")
    folder = publish(spark, out, d, updated, prefix="window.X = ").folder()
    doc = _document(f"{folder}/document.js")
    assert doc["updated"] == "01 Mar 2026, 10:00 IST"
    assert len(doc["rows"]) == out.envelope.count()
    assert sum(r[4] for r in doc["rows"]) == out.calls.count()
    assert doc["ctypes"] == ["Offline SC", "Online SC", "FU", "PQ", "RR"]
    assert doc["providers"] == sorted(doc["providers"]) and doc["weeks"] == sorted(doc["weeks"])
    # every reason id decodes, and nc counts match the cells
    reasons = doc["reasons"]
    nc_doc = sum(n for r in doc["rows"] for tab in r[7:10] for _, n in tab[2])
    assert nc_doc == out.cells.agg(F.sum("nc")).first()[0]
    assert all(0 <= ix < len(reasons) for r in doc["rows"] for tab in r[7:10] for ix, _ in tab[2] + tab[3])
    assert len(doc["er"]) == out.funnel.select("wk", "provider_name", "ctype", "diag").distinct().count()
    keys = [tuple(r[:4]) for r in doc["rows"]]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_cells_without_a_provider_name_are_published(spark, updated):
    tabs = spark.createDataFrame(
        [("2026-03-02", p, "FU", "Others", e, None if e else "why", t, s, n) for t in ("meds", "tests", "therapy")
         for p, e, s, n in ((None, 1, "cv", 2), ("Dr A", 1, "nc:Budget / price", 3), (None, 0, "nr:x", 1))],
        "wk string, provider_name string, ctype string, diag string, elig int, ne_reason string, tab string, status string, n long")
    measures = ", ".join(f"{m} long" for m in FN.MEASURE_NAMES)
    funnel = spark.createDataFrame([("2026-03-02", p, "FU", "Others", "x", None, None, n, n, *[n] * 39) for p, n in ((None, 3), ("Dr A", 3))],
                                   "wk string, provider_name string, ctype string, diag string, m_nr string, t_nr string, th_nr string, n long, elig long, " + measures)
    cells, reasons = CE.grain_cells(tabs), CE.grain_reason_counts(tabs)
    enc = P.encode_outputs(cells, reasons, funnel)
    assert enc.rows.count() == enc.er.count() == 2
    got = {(r.provider_name, r.tab, r.kind, r.reason): r.n for r in P.decode_rows(enc).collect()}
    assert got[(None, None, "calls", None)] == 3 and got[(None, None, "ne", "why")] == 1 and got[("Dr A", "meds", "nc", "Budget / price")] == 3
    assert {(r.provider_name, r.reason): r.n for r in P.decode_er(enc).filter("measure = 'nr'").collect()} == {(None, "x"): 3, ("Dr A", "x"): 3}
    d = tempfile.mkdtemp(prefix="callfunnel-doc-")
    P.write_document(P.document_lines(enc, updated, "window.X = "), f"{d}/doc")
    assert _document(f"{d}/doc.js")["providers"] == [None, "Dr A"]


def _above_facts(df) -> str:
    """The optimized plan's steps that get a row for each fact of a cell."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan[:plan.index("Generate explode")]


def test_er_facts_get_their_names_by_cell(out):
    assert _above_facts(P.decode_er(out.encoded)).count("Join ") == 1  # the reasons; weeks and providers are below


def test_row_facts_get_their_names_by_cell(out):
    assert _above_facts(P.decode_rows(out.encoded)).count("Join ") == 1


def test_cells_are_dealt_out_by_their_key_once(spark, out):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        enc = P.encode_outputs(out.cells, out.reasons, out.funnel)
        for df, most in ((enc.rows, 1), (enc.er, 2)):  # er: its reasons are counted by cell and label first
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(") == most, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_document_does_not_deal_out_rows_to_find_the_first(spark, out, updated):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        names = "wk string, provider_name string, ctype string, diag string, wk_ix long, provider_ix long, ctype_ix long, diag_ix long, "
        rows, er = (spark.range(9).selectExpr(*[f"CAST(id AS {c.split()[1]}) AS {c.split()[0]}" for c in f"{names}{j} string".split(", ")]) for j in ("row_json", "er_json"))
        plan = P.document_lines(replace(out.encoded, rows=rows, er=er), updated)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" in plan or "BroadcastHashJoin" in plan
        assert "SortMergeJoin" not in plan and "hashpartitioning(wk_ix" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_published_document_query_reads_written_rows(spark):
    plan = Q.QUERIES["publish_doc"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_json" in plan and "collect_list" not in plan  # the rows' reasons aren't gathered once more for the document


def test_drift_stops_publishing(spark, out, updated):
    d = tempfile.mkdtemp(prefix="callfunnel-doc-")
    bad = replace(out, totals=CE.reconcile_totals(out.tabs.filter("tab <> 'meds' OR elig = 1")))
    with pytest.raises(AssertionError, match="totals differ"):
        publish(spark, bad, d, updated)
    assert os.listdir(d) == []


def test_unknown_dimension_value_stops_encoding(spark):
    with pytest.raises(Exception, match="unknown ctype"):
        E.fixed_positions(spark.createDataFrame([("Walk-in",)], "ctype string"), "ctype", ("FU",), "ctype_ix").collect()


def test_positions_over_many_partitions(spark):
    names = [None, *(f"Dr {i % 700:04d}" for i in range(3000))]
    df = spark.createDataFrame([(n,) for n in names], "provider_name string")
    got = {r.provider_name: r.provider_ix for r in E.spread_positions(df, "provider_name", "provider_ix").collect()}
    want = [None, *sorted({n for n in names if n})]
    assert got == {n: i for i, n in enumerate(want)}


def test_protected_document_opens_with_the_secret_alone(spark, out, updated):
    d = tempfile.mkdtemp(prefix="callfunnel-doc-")
    d = publish(spark, out, d, updated, prefix="window.X = ", secret="a test secret").folder()
    assert not os.path.exists(f"{d}/document.js")
    payload = "".join(open(f"{d}/protected/payload/{p}").read() for p in os.listdir(f"{d}/protected/payload") if p.startswith("part-"))
    assert "Dr" not in payload[:20] and "window" not in payload
    text = "".join(r.line for r in P.read_protected(spark, f"{d}/protected", "a test secret").collect())
    assert len(json.loads(text[len("window.X = "):-1])["rows"]) == out.envelope.count()
    with pytest.raises(Exception):
        P.read_protected(spark, f"{d}/protected", "another secret").collect()


def test_protect_roundtrip_hides_and_restores(spark, out):
    key = P.derive_key("a test secret", salt=b"0123456789abcdef", iterations=1000)
    enc = P.protect(out.cells, key[0])
    assert "calls" not in enc.first().payload
    plan = enc._jdf.queryExecution().toString()
    assert "[_id" in plan and str(list(key[0])[:4])[1:-1] not in plan and key[0].hex().upper() not in plan.upper()
    back = P.unprotect(enc, key[0], out.cells.schema)
    assert sorted(back.collect()) == sorted(out.cells.collect())


def test_no_secret_no_protection(monkeypatch):
    monkeypatch.delenv("CALLFUNNEL_SECRET", raising=False)
    with pytest.raises(ValueError, match="CALLFUNNEL_SECRET"):
        P.secret_from_env()


def test_the_oracle_imports_nothing_from_the_package():
    source = open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "oracle_sql.py")).read()
    assert "from callfunnel" not in source and "import callfunnel" not in source


def test_oracle_gate(spark):
    from oracle_compare import compare
    res = compare(spark, SF, names=list(Q.QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not (v == "OK" or v.startswith("rows-only"))}
    assert not bad, bad
    assert len(res) == len(Q.QUERIES)
