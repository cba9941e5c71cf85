"""DuckDB oracle SQL for `__spark_entry__.oracle_sql()`.

Nothing is imported from the package: the adapter views (FIXTURES.md §2), the
rule ladders and every derived relation are stated here once more, in another
formulation. Ladders are a table of patterns that texts are joined to; what is
known about encounters and calls is one tall relation of facts (who, fact),
unnested from lists; outcomes and measures are small tables of flag tuples
that the calls' tuples are joined to. Only the test phrases, which are inputs,
are read from the JSON file that the adapters read.
"""

from __future__ import annotations

import json
import os

with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "callfunnel", "sources", "fixture_text.json"), encoding="utf-8") as _f:
    _FIXTURES = json.load(_f)
TITLES, PHRASES, PROBES = _FIXTURES["titles"], _FIXTURES["phrases"], _FIXTURES["probes"]
CALL_TYPES = _FIXTURES["call_types"]

# run parameters that fit the driver tables
SUB = "TIMESTAMP '1995-06-01 00:00:00'"
APPT = "TIMESTAMP '1995-07-03 00:00:00'"
SHIFT = "INTERVAL 330 MINUTE"
ONLINE = "0, 1, 2, 3, 4"
THER = "1"


def S(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else S(v) for v in values) + "]"


def _form_value() -> str:
    arms = []
    for i, (_, fam) in enumerate(TITLES):
        opts = PHRASES[fam]
        arms.append(f"WHEN {i} THEN {_list(opts)}[((l_partkey * 7 + l_suppkey) % {len(opts)}) + 1]")
    return "CASE l_partkey % " + str(len(TITLES)) + " " + " ".join(arms) + " END"


ADAPTERS = f"""
appointments AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS patient_id, o.o_custkey // 15 AS provider_id,
         CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS type_id,
         CAST(c.c_nationkey AS BIGINT) AS location_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RECONSULTED'
                              WHEN 'P' THEN 'CANCELLED' END AS status,
         o.o_orderdate + (o.o_orderkey % 24) * INTERVAL 1 HOUR AS start_time,
         CASE WHEN o.o_orderkey % 50 = 7 THEN o.o_orderdate END AS deleted_at
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
call_types AS (
  SELECT CAST(id AS BIGINT) AS id, name, CAST(NULL AS TIMESTAMP) AS deleted_at
  FROM (VALUES {", ".join(f"({k}, {S(n)})" for k, n in CALL_TYPES)}) v(id, name)),
providers AS (SELECT s_suppkey AS id, s_name AS name FROM supplier),
li AS (
  SELECT *, l_orderkey * 2 + CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS enc,
         CASE l_returnflag WHEN 'A' THEN 'drug' WHEN 'R' THEN 'lab' WHEN 'N' THEN 'consultation' END AS kind,
         CASE WHEN l_discount > 0.065 THEN 'Recommended' WHEN l_discount < 0.015 THEN NULL
              ELSE 'Essentials' END AS tier,
         CAST(CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END AS BIGINT) AS cons_id,
         CAST(floor(l_quantity) AS BIGINT) AS qty
  FROM lineitem),
encounters AS (
  SELECT l.l_orderkey * 2 + CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS id,
         o.o_custkey AS patient_id, l.l_orderkey AS appointment_id,
         CASE WHEN l.l_linestatus = 'F' THEN 'Merged-RX' ELSE 'Standard' END AS type,
         min(l.l_shipdate) AS created_at,
         CASE WHEN l.l_orderkey % 40 = 3 THEN min(l.l_shipdate) END AS deleted_at
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  GROUP BY l.l_orderkey, l.l_linestatus, o.o_custkey),
drug_orders_src AS (
  SELECT enc AS encounter_id, l_partkey AS drug_id, tier AS importance_level, l_shipdate AS created_at,
         CASE WHEN l_quantity > 49.5 THEN l_shipdate END AS deleted_at FROM li WHERE l_returnflag = 'A'),
lab_orders_src AS (
  SELECT enc AS encounter_id, l_partkey AS lab_test_id, tier AS importance_level, l_shipdate AS created_at,
         CASE WHEN l_quantity > 49.5 THEN l_shipdate END AS deleted_at FROM li WHERE l_returnflag = 'R'),
therapy_orders_src AS (
  SELECT enc AS encounter_id, cons_id AS consultation_id, qty AS quantity,
         qty - CASE WHEN l_tax > 0.055 THEN 1 ELSE 0 END AS remaining_quantity,
         tier AS importance_level, l_shipdate AS created_at,
         CASE WHEN l_quantity > 49.5 THEN l_shipdate END AS deleted_at FROM li WHERE l_returnflag = 'N'),
drug_inventory AS (
  SELECT p_partkey AS id, CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS is_verified
  FROM part WHERE p_partkey % 20 <> 0),
invoices AS (
  SELECT inv AS id, enc AS encounter_id,
         CASE WHEN inv % 35 = 4 THEN NULL WHEN inv % 5 = 0 THEN 'cancelled' WHEN inv % 5 = 4 THEN 'raised'
              ELSE 'paid' END AS status,
         min(l_shipdate) AS created_at, CASE WHEN inv % 60 = 11 THEN min(l_shipdate) END AS deleted_at
  FROM (SELECT enc * 2 + l_linenumber % 2 AS inv, enc, l_shipdate FROM li) x GROUP BY inv, enc),
invoice_items AS (
  SELECT enc * 2 + l_linenumber % 2 AS invoice_id, kind AS type,
         CASE WHEN l_returnflag = 'N' THEN cons_id ELSE l_partkey END AS type_id,
         CAST(NULL AS TIMESTAMP) AS deleted_at FROM li WHERE l_tax > 0.035),
form_answers AS (
  SELECT enc AS encounter_id, {_list([t for t, _ in TITLES])}[(l_partkey % {len(TITLES)}) + 1] AS title,
         {_form_value()} AS value, l_shipdate AS created_at,
         CASE WHEN l_quantity < 1.5 THEN l_shipdate END AS deleted_at FROM li),
encounter_tags AS (
  SELECT enc AS encounter_id, kind AS item_type, qty % 3 AS dss_quantity,
         CASE WHEN l_linenumber < 6 THEN 'item' ELSE 'encounter' END AS tag_category,
         l_shipdate AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at FROM li),
preferences AS (
  SELECT event_id * 3 AS encounter_id,
         CASE event_type WHEN 'purchase' THEN 'drug' WHEN 'error' THEN 'drug' WHEN 'view' THEN 'lab_test'
                         WHEN 'click' THEN 'consultation' WHEN 'signup' THEN 'encounter' END AS preference_type,
         CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS opt_out,
         {_list(PHRASES['optout'])}[(user_id % {len(PHRASES['optout'])}) + 1] AS opt_out_reason,
         ts AS created_at, CAST(NULL AS TIMESTAMP) AS deleted_at FROM events)"""


# FIXED VALUES: the rule ladders. Per ladder, what a null text and any other text is, then the
# rungs: a label, and per group of alternatives (all groups must match) regular expressions that are
# searched for in the lower-case text. `~` stands for any run of characters.
SHORT = "^ *([^ ]|[^ ].?[^ ])? *$"
LADDERS = {
    "optout": ("Opt-out logged (no reason)", "Other opt-out", [
        ("Left clinic before purchase chat", ["left the clinic"]),
        ("Phlebo not available", ["phlebo"]),
        ("Not serviceable / no stock", ["unservi|not servi|no stock|not available"]),
        ("Will buy / do it outside", ["outside|known pharmacy|known lab|preferred lab|elsewhere"]),
        ("Budget / price", ["budget|price|money|afford|financial"]),
        ("Does not believe in therapy", ["believe"]),
        ("Fear of side effects", ["side effect"]),
        ("Doctor marked optional", ["optional"]),
        ("Wants to try meds first", ["check if medicine|medicines work|medicine work|try medicine|few days|helps"]),
        ("Already has it / done recently", ["already|recent report|recently"]),
        ("Test due later", ["due date|later date"]),
        ("Wants to buy later / needs time", ["later|time to think|discuss|second opinion|decide"]),
        ("Not interested / not needed", ["not interested|not needed|not required|are needed|doesn~want|don~want"])]),
    "diagnosis": ("Others", "Others", [
        ("MH", ["mental health concern"]),
        ("STI", ["genito urinary infection|gui|post-exposure"]),
        ("ED+PE+", ["premature ejaculation", "erectile dysfunction"]),
        ("ED+", ["erectile dysfunction"]),
        ("PE+", ["premature ejaculation"])]),
    "meds_skip": ("Other", "Other", [
        ("Not clinically indicated", ["not clinically indicated"]),
        ("Already on equivalent medication", ["already"]),
        ("Deferred - lifestyle/therapy first", ["deferred|lifestyle|therapy-first|therapy advised"]),
        ("Awaiting test results", ["awaiting test|test result|waiting"]),
        ("Contraindication / adverse reaction", ["contraindication|allergy|adverse|side effect"]),
        ("Cost concerns", ["cost|expense|cheaper"]),
        ("Not required", ["not required|not needed|not requiring"])]),
    "no_rx_needed": ("Other", "Other", [
        ("Has meds already / remaining", ["remain|has med|have med|already|medicines are there|rx complete|^ *(has|rm) *$"]),
        ("Completely treated", ["treat"]),
        ("Report reading / reports normal", ["report|^ *rr|wnl|normal|negative"]),
        ("Query session", ["^ *pq|quer|^ *pt q"]),
        ("Referred out", ["refer"]),
        ("Not eligible", ["eligib|^ *(ne|n/e) *$"]),
        ("Counseled - no treatment needed", ["counsel"]),
        ("Not specified", [SHORT])]),
    "meds_not_required": ("Other", "Other", [
        ("Awaiting test results", ["awaiting test|test result"]),
        ("Therapy first - meds not needed now", ["therapy|counsel"]),
        ("Mild / watchful waiting", ["mild|watchful|situational"]),
        ("Already has / taken meds", ["already"]),
        ("No symptoms", ["no symptom"])]),
    "eligibility": ("Other", "Other", [
        ("Anatomical / physical concern", ["anatomical|physical|phimosis"]),
        ("Not a sexual-health concern", ["not a sexual health|nssd|other issues"]),
        ("STI referral to specialist", ["sti", "referral|specialist"]),
        ("Sex-ed / doubts only", ["sex ed|education|doubt|quer|myth"]),
        ("Proxy consultation", ["proxy"]),
        ("Minor (underage)", ["minor"]),
        ("Not specified", [SHORT])]),
    "tests": ("Other", "Other", [
        ("Not clinically indicated", ["not clinically indicated"]),
        ("Clinical dx sufficient (empirical Rx)", ["empirical|diagnosis sufficient"]),
        ("Deferred to follow-up", ["defer|follow"]),
        ("Recently / already done", ["already|recently|done"]),
        ("Affordability", ["afford"])]),
    "therapy": ("Other", "Other", [
        ("Not clinically indicated", ["not clinically indicated"]),
        ("Deferred - reassess at follow-up", ["defer|reassess|follow"]),
        ("Mild - meds/lifestyle enough", ["mild"]),
        ("Needs outside specialist", ["scope|specialist"]),
        ("Already in / had therapy", ["already|receiving|elsewhere|pending session"]),
        ("Beneficial but optional - supports meds", ["supports|strengthens|sustains|relationship|couple|coping|anxiety|relapse"]),
        ("Patient prefers meds first", ["medication first|meds first"]),
        ("Skeptical / stigma concerns", ["skeptical|stigma|privacy"]),
        ("Affordability", ["afford"])]),
}

# FIXED VALUES: form questions, and the reason column and ladder that each feeds.
QUESTIONS = [
    ("Reason for not prescribing a recommended medication", "meds_norx", "meds_skip"),
    ("Why are medications not required for this patient?", "meds_noreq", "meds_not_required"),
    ("What is the reason for non-eligibility?", "elig_reason", "eligibility"),
    ("Why does the patient not need a prescription?", "meds_norx_fb", "no_rx_needed"),
    ("What is the reason for the patient not needing a prescription?", "meds_norx_fb", "no_rx_needed"),
    ("Why were no diagnostic tests recommended?", "tests_norx", "tests"),
    ("Why is therapy not being recommended?", "ther_norx", "therapy"),
    ("Why is therapy beneficial but not essential for this patient?", "ther_norx", "therapy"),
    ("Why doesn't the patient believe in therapy?", "ther_norx", "therapy"),
]
REASON_COLS = ["meds_norx", "meds_norx_fb", "meds_noreq", "elig_reason", "tests_norx", "ther_norx"]
PREFERENCES = [("drug", "opt_drug"), ("lab_test", "opt_lab"), ("consultation", "opt_ther"), ("encounter", "opt_enc")]
# FIXED VALUES: labels of calls without a stated reason; orders of call types and diagnoses.
NO_REASON = "No reason recorded"
UNSERVICEABLE = "No opt-out logged - >=1 med not serviceable"
UNPAID = "No opt-out logged - invoice unpaid"
NO_INVOICE = "No opt-out logged - no invoice"
CTYPES = ["Offline SC", "Online SC", "FU", "PQ", "RR"]
DIAGS = ["MH", "STI", "ED+", "PE+", "ED+PE+", "Others"]

_RULES = ", ".join(f"({S(name)}, {r}, {g}, {len(groups)}, {S(label)}, {S('(?s)' + rx.replace('~', '.*'))})"
                   for name, (_, _, rungs) in LADDERS.items() for r, (label, groups) in enumerate(rungs) for g, rx in enumerate(groups))
_ENDS = ", ".join(f"({S(name)}, {S(null)}, {S(other)})" for name, (null, other, _) in LADDERS.items())


def labelled(texts: str) -> str:
    """CTEs: `label_of(ladder, txt, label)` for the distinct (ladder, txt) of the query `texts`."""
    return f"""
rule(ladder, rung, part, parts, label, rx) AS (VALUES {_RULES}),
ends(ladder, if_null, other) AS (VALUES {_ENDS}),
txts AS (SELECT DISTINCT ladder, txt FROM ({texts}) q),
met AS (SELECT t.ladder, t.txt, r.rung, r.label FROM txts t JOIN rule r ON r.ladder = t.ladder AND regexp_matches(lower(t.txt), r.rx)
        GROUP BY t.ladder, t.txt, r.rung, r.label, r.parts HAVING count(DISTINCT r.part) = r.parts),
label_of AS (SELECT t.ladder, t.txt, CASE WHEN t.txt IS NULL THEN e.if_null ELSE coalesce(m.label, e.other) END AS label
             FROM txts t JOIN ends e ON e.ladder = t.ladder
             LEFT JOIN (SELECT ladder, txt, arg_min(label, rung) AS label FROM met GROUP BY ladder, txt) m ON m.ladder = t.ladder AND m.txt = t.txt)"""


def _facts(*named: tuple[str, str]) -> str:
    """The names whose condition holds, as a list."""
    return "list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in named) + "], lambda f: f IS NOT NULL)"


def has(fact: str, flags: str = "flags") -> str:
    return f"CAST(coalesce(list_contains({flags}, '{fact}'), false) AS INTEGER)"


def _tiers(p: str, done: str | None = None) -> list[tuple[str, str]]:
    out = [(f"{p}_rec", "tier = 'Recommended'"), (f"{p}_ess", "tier IS DISTINCT FROM 'Recommended'")]
    return out + [(f"{n}_done", f"{c} AND {done}") for n, c in out] if done else out


_QUESTIONS = ", ".join(f"({S(t)}, '{c}', '{lad}')" for t, c, lad in QUESTIONS)
_LIVE = f"deleted_at IS NULL AND created_at >= {SUB}"
_PAID = "EXISTS (FROM paid p WHERE p.type = '{k}' AND p.encounter_id = o.encounter_id AND p.type_id = o.item)"

DOMAIN = f"""
paid AS (
  SELECT DISTINCT i.encounter_id, it.type, it.type_id FROM invoices i, invoice_items it
  WHERE it.invoice_id = i.id AND it.deleted_at IS NULL AND it.type IN ('drug', 'lab') AND i.status = 'paid'
    AND i.deleted_at IS NULL AND i.created_at >= {SUB}),
drug_order AS (SELECT encounter_id, drug_id AS item, importance_level AS tier FROM drug_orders_src WHERE {_LIVE}),
lab_order AS (SELECT encounter_id, lab_test_id AS item, importance_level AS tier FROM lab_orders_src WHERE {_LIVE}),
fact AS (
  SELECT DISTINCT encounter_id, unnest(facts) AS fact FROM (
    SELECT encounter_id, {_facts(("d", "true"), *_tiers("d", _PAID.format(k="drug")), ("d_unsvc", "NOT EXISTS (FROM drug_inventory v WHERE v.id = o.item) OR EXISTS (FROM drug_inventory v WHERE v.id = o.item AND v.is_verified = 0)"))} AS facts FROM drug_order o
    UNION ALL
    SELECT encounter_id, {_facts(("l", "true"), *_tiers("l", _PAID.format(k="lab")))} FROM lab_order o
    UNION ALL
    SELECT encounter_id, {_facts(("t", "true"), *_tiers("t", "used"), ("t_used", "used"))}
    FROM (SELECT encounter_id, importance_level AS tier, remaining_quantity < quantity AS used FROM therapy_orders_src WHERE {_LIVE} AND consultation_id = {THER}) o
    UNION ALL
    SELECT i.encounter_id, {_facts(("i", "true"), *[(f"i_{n}{s}", f"{c}{x}") for n, c in (("drug", "it.type = 'drug'"), ("lab", "it.type = 'lab'"), ("ther", f"it.type = 'consultation' AND it.type_id = {THER}")) for s, x in (("", ""), ("_paid", " AND i.status = 'paid'"))])}
    FROM invoices i, invoice_items it
    WHERE it.invoice_id = i.id AND it.deleted_at IS NULL AND i.status <> 'cancelled' AND i.deleted_at IS NULL AND i.created_at >= {SUB}
    UNION ALL
    SELECT encounter_id, {_facts(("g", "true"), *[(f"g_{k}", f"item_type = '{k}' AND dss_quantity > 0") for k in ("drug", "lab", "consultation")])}
    FROM encounter_tags WHERE {_LIVE} AND tag_category = 'item') f),
flagged AS (SELECT encounter_id, list(fact) AS flags FROM fact GROUP BY encounter_id),
question(title, col, ladder) AS (VALUES {_QUESTIONS}),
asked AS (
  SELECT a.encounter_id, q.col, q.ladder, a.value AS txt FROM form_answers a JOIN question q ON q.title = a.title WHERE a.{_LIVE.replace("created_at", "a.created_at")}
  UNION ALL
  SELECT encounter_id, CASE preference_type {" ".join(f"WHEN '{k}' THEN '{c}'" for k, c in PREFERENCES)} END, 'optout', opt_out_reason
  FROM preferences WHERE {_LIVE} AND opt_out = 1),
dx AS (
  SELECT e.id AS encounter_id, e.patient_id, e.created_at, (
    SELECT string_agg(a.value, ',' ORDER BY a.value) FROM form_answers a WHERE a.encounter_id = e.id AND a.deleted_at IS NULL AND contains(lower(a.title), 'diagnosis')) AS txt
  FROM encounters e WHERE e.deleted_at IS NULL AND contains(lower(e.type), 'merged-rx')),
{labelled("SELECT ladder, txt FROM asked UNION ALL SELECT 'diagnosis', txt FROM dx")},
said AS (SELECT a.encounter_id, a.col, a.ladder, l.label FROM asked a JOIN label_of l ON l.ladder = a.ladder AND l.txt IS NOT DISTINCT FROM a.txt),
dxl AS (SELECT dx.*, l.label AS diag_cat FROM dx JOIN label_of l ON l.ladder = 'diagnosis' AND l.txt IS NOT DISTINCT FROM dx.txt),
diag AS (
  SELECT patient_id, diag_cat FROM dxl d WHERE NOT EXISTS (
    FROM dxl b WHERE b.patient_id IS NOT DISTINCT FROM d.patient_id AND b.encounter_id <> d.encounter_id AND (
      (b.created_at IS NULL AND d.created_at IS NOT NULL) OR b.created_at > d.created_at
      OR (b.created_at IS NOT DISTINCT FROM d.created_at AND b.encounter_id < d.encounter_id)))),
dims AS (
  SELECT a.id AS appt_id, a.patient_id, a.location_id, a.start_time, t.name AS type_name, p.name AS provider_name
  FROM appointments a, (SELECT DISTINCT id, name FROM call_types WHERE deleted_at IS NULL) t, (SELECT DISTINCT id, name FROM providers) p
  WHERE t.id = a.type_id AND p.id = a.provider_id AND a.deleted_at IS NULL AND a.status IN ('COMPLETED', 'RECONSULTED')
    AND t.name IN ('Screening Call', 'Follow Up', 'Report Reading', 'Patient Queries') AND a.start_time >= {APPT} - {SHIFT}),
base AS (
  SELECT DISTINCT appt_id, patient_id, strftime(date_trunc('week', start_time + {SHIFT}), '%Y-%m-%d') AS wk, provider_name,
         coalesce(map {{'Follow Up': 'FU', 'Patient Queries': 'PQ', 'Report Reading': 'RR'}}[type_name],
                  list_extract(['Offline SC', 'Online SC'], 1 + CAST(coalesce(location_id IN ({ONLINE}), false) AS INTEGER))) AS ctype
  FROM dims),
visit AS (SELECT id AS encounter_id, appointment_id FROM encounters WHERE {_LIVE} AND appointment_id IS NOT NULL),
call_flag AS (SELECT v.appointment_id, list(DISTINCT f.fact) AS flags FROM visit v JOIN fact f ON f.encounter_id = v.encounter_id GROUP BY v.appointment_id),
call_said AS (SELECT v.appointment_id, {", ".join(f"max(s.label) FILTER (WHERE s.col = '{c}') AS {c}" for c in REASON_COLS + [c for _, c in PREFERENCES])}
              FROM visit v JOIN said s ON s.encounter_id = v.encounter_id GROUP BY v.appointment_id),
calls AS (
  SELECT b.*, {has("d")} AS meds_rx, {has("i_drug_paid")} AS meds_conv, 1 - {has("d_unsvc")} AS meds_all_svc, {has("i_drug")} AS meds_inv,
         {has("l")} AS tests_rx, {has("i_lab_paid")} AS tests_conv, {has("i_lab")} AS tests_inv,
         {has("t")} AS ther_rx, CAST(coalesce(list_has_any(flags, ['t_used', 'i_ther_paid']), false) AS INTEGER) AS ther_conv, {has("i_ther")} AS ther_inv,
         {", ".join(f"{has(f'{k}_{tier}')} AS {p}_{tier}" for k, p in (("d", "m"), ("l", "t"), ("t", "th")) for tier in ("ess", "rec"))},
         {has("g_drug")} AS m_dss, {has("g_lab")} AS t_dss, {has("g_consultation")} AS th_dss,
         s.* EXCLUDE (appointment_id)
  FROM base b LEFT JOIN call_flag f ON f.appointment_id = b.appt_id LEFT JOIN call_said s ON s.appointment_id = b.appt_id),
dxcalls AS (
  SELECT c.*, coalesce(d.diag_cat, 'Others') AS diag, CAST(1 IN (meds_rx, tests_rx, ther_rx) AS INTEGER) AS elig,
         CASE WHEN 1 NOT IN (meds_rx, tests_rx, ther_rx) THEN list_filter([elig_reason, meds_norx_fb, {S(NO_REASON)}], lambda r: r IS NOT NULL)[1] END AS ne_reason
  FROM calls c LEFT JOIN diag d ON d.patient_id = c.patient_id)"""

GRAIN = ("wk", "provider_name", "ctype", "diag")
G = ", ".join(GRAIN)
TABS = ("meds", "tests", "therapy")
# per tab: what was ordered, paid and invoiced, what opt-out and other reasons apply in turn
_LONG = ", ".join((
    f"('meds', meds_rx, meds_conv, [opt_drug, opt_enc, CASE meds_all_svc WHEN 0 THEN {S(UNSERVICEABLE)} END, CASE meds_inv WHEN 1 THEN {S(UNPAID)} END, {S(NO_INVOICE)}], [meds_noreq, meds_norx, meds_norx_fb, {S(NO_REASON)}])",
    f"('tests', tests_rx, tests_conv, [opt_lab, opt_enc, CASE tests_inv WHEN 1 THEN {S(UNPAID)} END, {S(NO_INVOICE)}], [tests_norx, {S(NO_REASON)}])",
    f"('therapy', ther_rx, ther_conv, [opt_ther, opt_enc, CASE ther_inv WHEN 1 THEN {S(UNPAID)} END, {S(NO_INVOICE)}], [ther_norx, {S(NO_REASON)}])"))

TABS_LONG = f"""
outcome(rx, conv, mark) AS (VALUES (1, 1, 'cv'), (1, 0, 'nc'), (0, 1, 'nr'), (0, 0, 'nr')),
tabbed AS (
  SELECT c.appt_id, {", ".join("c." + g for g in GRAIN)}, c.elig, c.ne_reason, t.tab, o.mark,
         CASE o.mark WHEN 'nc' THEN list_filter(t.nc, lambda r: r IS NOT NULL)[1] WHEN 'nr' THEN list_filter(t.nr, lambda r: r IS NOT NULL)[1] END AS why
  FROM dxcalls c, LATERAL (VALUES {_LONG}) t(tab, rx, conv, nc, nr), outcome o WHERE o.rx = t.rx AND o.conv = t.conv),
settled AS (
  SELECT *, concat_ws(':', mark, why) AS status, CASE elig WHEN 0 THEN 'ne' ELSE mark END AS kind,
         CASE elig WHEN 0 THEN ne_reason ELSE why END AS reason FROM tabbed),
tab_grain AS (SELECT {G}, elig, ne_reason, tab, status, count(*) AS n FROM settled GROUP BY ALL),
kind_count AS (SELECT {G}, tab, map_from_entries(list((kind, n))) AS k, sum(n) AS calls FROM (SELECT {G}, tab, kind, count(*) AS n FROM settled GROUP BY ALL) q GROUP BY ALL),
cells AS (
  SELECT {G}, tab, CAST(calls AS BIGINT) AS calls, CAST(calls - ne AS BIGINT) AS elig, cv + nc AS rx, cv, nc, nr, ne
  FROM (SELECT *, {", ".join(f"coalesce(k['{k}'], 0) AS {k}" for k in ("cv", "nc", "nr", "ne"))} FROM kind_count) q),
reason_count AS (SELECT {G}, tab, kind, reason, count(*) AS n FROM settled WHERE kind <> 'cv' GROUP BY ALL),
envelope AS (
  SELECT {G}, max(calls) AS calls, max(elig) AS elig, max(ne) AS ne,
         (list(tab ORDER BY ne DESC, list_position({_list(TABS)}, tab)) FILTER (WHERE ne > 0))[1] AS ne_tab FROM cells GROUP BY {G})"""

COMPS = ("m", "t", "th")
# a measure counts the calls whose flags are as given (None: either)
MEASURES = {  # recommended, prescribed, converted, essential tier, recommended tier
    "dss": (1, None, None, None, None), "dss_norx": (1, 0, None, None, None), "nodss_rx": (0, 1, None, None, None),
    "rx": (None, 1, None, None, None), "cv": (None, 1, 1, None, None), "dss_cv": (1, 1, 1, None, None), "nodss_cv": (0, 1, 1, None, None),
    "ae": (None, 1, None, 1, 0), "ae_cv": (None, 1, 1, 1, 0), "er": (None, 1, None, 1, 1), "er_cv": (None, 1, 1, 1, 1),
    "or": (None, 1, None, 0, 1), "or_cv": (None, 1, 1, 0, 1),
}
_TUPLES = ", ".join(f"('{m}', {', '.join('NULL' if x is None else str(x) for x in t)})" for m, t in MEASURES.items())
_FLAGS = ("dss", "rx", "conv", "ess", "rec")
_COMP_ROWS = ", ".join(f"('{p}', {dss}, {rx}, {conv}, {p}_ess, {p}_rec, list_filter([{', '.join(nr)}, {S(NO_REASON)}], lambda r: r IS NOT NULL)[1])" for p, dss, rx, conv, nr in (
    ("m", "m_dss", "meds_rx", "meds_conv", ("meds_noreq", "meds_norx", "meds_norx_fb")),
    ("t", "t_dss", "tests_rx", "tests_conv", ("tests_norx",)),
    ("th", "th_dss", "ther_rx", "ther_conv", ("ther_norx",))))
_NRS = ", ".join(f"{p}_nr" for p in COMPS)
_NAMES = [f"{p}_{m}" for p in COMPS for m in MEASURES]
_PIVOT = ", ".join(f"CAST(coalesce(sum(v) FILTER (WHERE name = '{x}'), 0) AS BIGINT) AS {x}" for x in _NAMES)
_ELIG = 'CAST(coalesce(sum(v) FILTER (WHERE name = \'elig\'), 0) AS BIGINT) AS elig'

FUNNEL = f"""
comp_row AS (
  SELECT c.appt_id, c.patient_id, {", ".join("c." + g for g in GRAIN)}, c.elig, x.*, CASE WHEN x.dss = 1 AND x.rx = 0 THEN x.why END AS nr
  FROM dxcalls c, LATERAL (VALUES {_COMP_ROWS}) x(comp, dss, rx, conv, ess, rec, why)),
with_nr AS (
  SELECT r.*, {", ".join(f"max(nr) FILTER (WHERE comp = '{p}') OVER w AS {p}_nr" for p in COMPS)}
  FROM comp_row r WINDOW w AS (PARTITION BY appt_id, patient_id, wk, provider_name, ctype)),
flag_tuple AS (SELECT {G}, {_NRS}, comp, {", ".join(_FLAGS)}, elig, count(*) AS n FROM with_nr GROUP BY ALL),
measure(measure, {", ".join("w_" + f for f in _FLAGS)}) AS (VALUES {_TUPLES}),
funnel_long AS (
  SELECT {G}, {_NRS}, comp || '_' || measure AS name, n AS v FROM flag_tuple, measure WHERE {" AND ".join(f"coalesce(w_{f}, {f}) = {f}" for f in _FLAGS)}
  UNION ALL SELECT {G}, {_NRS}, 'n', n FROM flag_tuple WHERE comp = 'm'
  UNION ALL SELECT {G}, {_NRS}, 'elig', n FROM flag_tuple WHERE comp = 'm' AND elig = 1),
funnel AS (SELECT {G}, {_NRS}, CAST(sum(v) FILTER (WHERE name = 'n') AS BIGINT) AS n, {_ELIG}, {_PIVOT} FROM funnel_long GROUP BY {G}, {_NRS}),
funnel_cell AS (SELECT {G}, CAST(sum(v) FILTER (WHERE name = 'n') AS BIGINT) AS calls, {_ELIG}, {_PIVOT} FROM funnel_long GROUP BY {G}),
funnel_reason AS (SELECT {G}, comp, nr AS reason, count(*) AS n FROM comp_row WHERE nr IS NOT NULL GROUP BY ALL),
week_ix AS (SELECT wk, row_number() OVER (ORDER BY wk NULLS FIRST) - 1 AS ix FROM (SELECT DISTINCT wk FROM cells) q),
provider_pos AS (SELECT provider_name, row_number() OVER (ORDER BY provider_name NULLS FIRST) - 1 AS ix FROM (SELECT DISTINCT provider_name FROM cells) q),
reason_pos AS (SELECT reason, row_number() OVER (ORDER BY reason) - 1 AS ix FROM (SELECT reason FROM reason_count UNION SELECT reason FROM funnel_reason) q WHERE reason IS NOT NULL)"""


def with_all(body: str) -> str:
    return "WITH " + ADAPTERS + "," + DOMAIN + "," + TABS_LONG + "," + FUNNEL + "\n" + body


# ---------------------------------------------------------------- per-query oracle bodies
def _ts_s(c: str, us: bool = False) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S{'.%f' if us else ''}')"


def _weekly(where: str = "") -> str:
    ratio = lambda a, b: f"round(a.{a} / nullif(a.{b}, 0), 6)"
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("calls", "elig", "rx", "cv", "nc", "nr", "ne"))
    return f"""SELECT wk, tab, calls, elig, rx AS prescribed, cv AS converted, nc AS not_converted, nr AS not_prescribed, ne AS not_eligible,
       {ratio("nr", "calls")} AS not_prescribed_pct_of_calls, {ratio("nr", "elig")} AS not_prescribed_pct_of_eligible, {ratio("nc", "rx")} AS not_converted_pct
FROM (SELECT wk, tab, {sums} FROM cells {where} GROUP BY wk, tab) a"""


def _audit(name: str, rel: str, key: str) -> str:
    return f"SELECT '{name}' AS relation, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, CAST(count(DISTINCT {key}) FILTER (WHERE c > 1) AS BIGINT) AS dup_keys FROM (SELECT {key}, count(*) OVER (PARTITION BY {key}) AS c FROM {rel}) k"


def _rows_of(fact: str, cols: str) -> str:
    return f"SELECT encounter_id, {cols} FROM flagged WHERE list_contains(flags, '{fact}')"


def _ladder_query(name: str) -> str:
    probes = PROBES[name]
    texts = f"""SELECT doc_id, 'document' AS part, text AS txt FROM documents
      UNION ALL SELECT doc_id, 'answer', {_list(probes)}[CAST(doc_id % {len(probes)} + 1 AS INTEGER)] FROM documents"""
    return f"""WITH src AS ({texts}), {labelled(f"SELECT '{name}' AS ladder, txt FROM src")}
SELECT doc_id, part, label FROM src JOIN label_of l ON l.txt IS NOT DISTINCT FROM src.txt"""


_TIER_COLS = lambda p: f"{has(p + '_rec')} AS has_rec, {has(p + '_ess')} AS has_ess, {has(p + '_rec_done')} AS rec_paid, {has(p + '_ess_done')} AS ess_paid"
_SAID = lambda cols, where: f"SELECT encounter_id, {', '.join(f'max(label) FILTER (WHERE col = {S(c)}) AS {c}' for c in cols)} FROM said WHERE {where} GROUP BY encounter_id"
_REASON_ROWS = _SAID(REASON_COLS, "ladder <> 'optout'")
_OPTOUT_ROWS = _SAID([c for _, c in PREFERENCES], "ladder = 'optout'")
_DX = "SELECT encounter_id, txt AS diagnosis, diag_cat FROM dxl"

ON_DRIVER = {f"ladder_{name}": _ladder_query(name) for name in LADDERS}
ON_DRIVER.update({
    "pred_ilike": "SELECT doc_id, " + ", ".join(f"CAST(regexp_matches(coalesce(lower(text), ''), '(?s){rx}') AS INTEGER) AS {n}" for n, rx in (
        ("has_later", "later"), ("has_the", "the "), ("has_dont_want", "don.*want"), ("has_on_the", "on.*the"))) + " FROM documents",
    "week_bucket": f"SELECT event_id, strftime(date_trunc('week', ts + {SHIFT}), '%Y-%m-%d') AS wk FROM events",
    "latest_per_key": f"""SELECT user_id, event_id, event_type, {_ts_s('ts', True)} AS ts FROM events e WHERE NOT EXISTS (
        FROM events b WHERE b.user_id IS NOT DISTINCT FROM e.user_id AND ((b.ts IS NULL AND e.ts IS NOT NULL) OR b.ts > e.ts
          OR (b.ts IS NOT DISTINCT FROM e.ts AND b.event_id < e.event_id)))""",
})

ON_ADAPTERS = {
    "filter_live": f"SELECT id, appointment_id, type, {_ts_s('created_at')} AS created_at FROM encounters WHERE deleted_at IS NULL",
    "filter_since": f"SELECT encounter_id, drug_id, importance_level, {_ts_s('created_at')} AS created_at FROM drug_orders_src WHERE created_at >= {SUB}",
    "filter_local_since": f"SELECT id, {_ts_s('start_time')} AS start_time FROM appointments WHERE start_time + {SHIFT} >= {APPT}",
    "filter_membership": f"SELECT id, status, location_id FROM appointments WHERE status IN ('COMPLETED', 'RECONSULTED') AND location_id IN ({ONLINE})",
    "filter_not_cancelled": "SELECT id, encounter_id, status FROM invoices WHERE status <> 'cancelled'",
    "paid_items_distinct": "SELECT encounter_id, type, type_id FROM paid",
    "join_paid_items": f"SELECT encounter_id, item AS drug_id, tier AS importance_level, CAST({_PAID.format(k='drug')} AS INTEGER) AS paid FROM drug_order o",
    "drug_rollup": _rows_of("d", f"1 - {has('d_unsvc')} AS all_svc, {_TIER_COLS('d')}"),
    "lab_rollup": f"SELECT f.*, (SELECT count(*) FROM lab_order o WHERE o.encounter_id = f.encounter_id) AS n FROM ({_rows_of('l', _TIER_COLS('l'))}) f",
    "therapy_rollup": _rows_of("t", f"{has('t_used')} AS consumed, {_TIER_COLS('t')}"),
    "invoice_flags": _rows_of("i", ", ".join(f"{has(f'i_{k}_paid')} AS {k}_paid, {has(f'i_{k}')} AS {k}_inv" for k in ("drug", "lab", "ther"))),
    "reason_pivot": _REASON_ROWS,
    "recommendation_flags": _rows_of("g", f"{has('g_drug')} AS dss_drug, {has('g_lab')} AS dss_lab, {has('g_consultation')} AS dss_ther"),
    "optout_pivot": _OPTOUT_ROWS,
    "text_concat_per_key": _DX,
    "latest_diagnosis": "SELECT patient_id, diag_cat FROM diag",
    "call_base": "SELECT * FROM base",
    "call_type": "SELECT appt_id, ctype FROM base",
    "join_call_dims": "SELECT appt_id, type_name, provider_name, location_id FROM dims",
    "join_presence_flags": "SELECT v.encounter_id, v.appointment_id, " + ", ".join(f"{has(f)} AS has_{n}" for f, n in (("d", "drug"), ("l", "lab"), ("t", "ther"), ("i", "inv"), ("g", "dss")))
        + ", " + ", ".join(f"CAST(EXISTS (FROM said s WHERE s.encounter_id = v.encounter_id AND (s.ladder = 'optout') = {b}) AS INTEGER) AS has_{n}" for n, b in (("reasons", "false"), ("optout", "true")))
        + " FROM visit v LEFT JOIN flagged f ON f.encounter_id = v.encounter_id",
    "call_rollup": "SELECT * FROM calls",
    "join_latest_diag": "SELECT appt_id, patient_id, diag FROM dxcalls",
    "eligibility": "SELECT appt_id, elig, ne_reason FROM dxcalls",
    "status_long": "SELECT appt_id, tab, status, kind, reason FROM settled",
    **{f"tab_{t}": f"SELECT {G}, elig, ne_reason, status, n FROM tab_grain WHERE tab = '{t}'" for t in TABS},
    "funnel_grain": "SELECT * FROM funnel",
    "funnel_cells": "SELECT * FROM funnel_cell",
    "funnel_reason_counts": "SELECT * FROM funnel_reason",
    "grain_cells": "SELECT * FROM cells",
    "grain_reason_counts": "SELECT * FROM reason_count",
    "cell_envelope": "SELECT * FROM envelope",
    "reconcile_totals": """SELECT meds AS meds_total, tests AS tests_total, therapy AS therapy_total, hi - lo AS drift,
        CASE WHEN hi = lo THEN 'ok' WHEN hi - lo > 0.001 * hi THEN 'fail' ELSE 'warn' END AS status
        FROM (SELECT *, greatest(meds, tests, therapy) AS hi, least(meds, tests, therapy) AS lo FROM (SELECT """
        + ", ".join(f"(SELECT count(*) FROM settled WHERE tab = '{t}') AS {t}" for t in TABS) + ") q) r",
    "weekly_metrics": _weekly(),
    "weekly_filtered": _weekly("WHERE ctype IN ('Online SC', 'Offline SC') AND diag IN ('Others', 'STI', 'MH')"),
    "filter_cube": f"""SELECT GROUPING(provider_name, ctype, diag) AS level, wk, tab, provider_name, ctype, diag, {
        ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("calls", "elig", "rx", "cv", "nc", "nr", "ne"))} FROM cells
        GROUP BY wk, tab, CUBE (provider_name, ctype, diag)""",
    "reason_breakdown": "SELECT tab, kind, reason, count(*) AS n FROM settled WHERE kind <> 'cv' GROUP BY ALL",
    "dim_weeks": "SELECT wk, ix AS wk_ix FROM week_ix",
    "dim_providers": "SELECT provider_name, ix AS provider_ix FROM provider_pos",
    "dim_ctype": f"SELECT DISTINCT ctype, CAST(list_position({_list(CTYPES)}, ctype) - 1 AS BIGINT) AS ctype_ix FROM cells",
    "dim_diag": f"SELECT DISTINCT diag, CAST(list_position({_list(DIAGS)}, diag) - 1 AS BIGINT) AS diag_ix FROM cells",
    "reason_dictionary": "SELECT reason, ix AS reason_ix FROM reason_pos",
    "reasons_ranked": f"SELECT r.*, row_number() OVER (PARTITION BY {G}, tab, kind ORDER BY n DESC, reason NULLS FIRST) - 1 AS pos FROM reason_count r",
    "publish_rows": f"""SELECT {G}, CAST(NULL AS VARCHAR) AS tab, kind, CAST(NULL AS VARCHAR) AS reason, n FROM (UNPIVOT (SELECT {G}, calls, elig FROM envelope) ON calls, elig INTO NAME kind VALUE n) u
        UNION ALL SELECT {G}, tab, kind, NULL, n FROM (UNPIVOT (SELECT {G}, tab, rx, cv FROM cells) ON rx, cv INTO NAME kind VALUE n) u
        UNION ALL SELECT {G}, tab, kind, reason, n FROM reason_count WHERE kind IN ('nc', 'nr')
        UNION ALL SELECT {", ".join("r." + g for g in GRAIN)}, NULL, 'ne', r.reason, r.n FROM reason_count r JOIN envelope e
          ON {" AND ".join(f"e.{g} IS NOT DISTINCT FROM r.{g}" for g in GRAIN)} AND e.ne_tab = r.tab WHERE r.kind = 'ne'""",
    "publish_er": f"""SELECT {G}, CASE WHEN m IN ('calls', 'elig') THEN NULL ELSE split_part(m, '_', 1) END AS comp,
          CASE WHEN m IN ('calls', 'elig') THEN m ELSE substr(m, strpos(m, '_') + 1) END AS measure, CAST(NULL AS VARCHAR) AS reason, n
        FROM (UNPIVOT funnel_cell ON COLUMNS(* EXCLUDE ({G})) INTO NAME m VALUE n) u
        UNION ALL SELECT {G}, comp, 'nr', reason, n FROM funnel_reason""",
    "publish_doc": """SELECT section, count(*) AS n, count(*) - 1 AS n_commas, CAST(sum(v) AS BIGINT) AS total FROM (
          SELECT 'weeks' AS section, ix AS v FROM week_ix UNION ALL SELECT 'providers', ix FROM provider_pos UNION ALL SELECT 'reasons', ix FROM reason_pos
          UNION ALL SELECT 'rows', calls FROM envelope UNION ALL SELECT 'er', calls FROM funnel_cell) q GROUP BY section""",
    "run_stamp": f"SELECT {_ts_s('max(start_time)')} AS as_of, strftime(max(start_time) + {SHIFT}, '%d %b %Y, %H:%M IST') AS updated FROM dims",
    "protect_roundtrip": "SELECT * FROM cells",
    "unique_keys_audit": " UNION ALL ".join([
        *[_audit(n, f"(SELECT encounter_id FROM flagged WHERE list_contains(flags, '{f}')) r", "encounter_id") for n, f in (
            ("drug_rollup", "d"), ("lab_rollup", "l"), ("therapy_rollup", "t"), ("invoice_flags", "i"), ("recommendation_flags", "g"))],
        _audit("reason_pivot", f"({_REASON_ROWS}) r", "encounter_id"), _audit("optout_pivot", f"({_OPTOUT_ROWS}) r", "encounter_id"),
        _audit("calls", "calls", "appt_id"), _audit("latest_diagnosis", "diag", "patient_id")]),
}


def oracle_queries() -> dict[str, str]:
    out = dict(ON_DRIVER)
    out.update({k: with_all(v) for k, v in ON_ADAPTERS.items()})
    return out
