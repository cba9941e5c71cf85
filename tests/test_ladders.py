"""One labelled phrase per ladder rung plus order / NULL traps (FIXTURES.md §3.2)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callfunnel.functions import ladders as L

FAMILY_LADDER = {"diagnosis": L.DIAGNOSIS, "skip": L.MEDS_SKIP, "fallback": L.NO_RX_NEEDED,
                 "noreq": L.MEDS_NOT_REQUIRED, "elig": L.ELIGIBILITY, "tests": L.TESTS, "therapy": L.THERAPY,
                 "optout": L.OPTOUT}

CASES = [
    ("diagnosis", None, "Others"), ("diagnosis", "mental health concern, mild", "MH"),
    ("diagnosis", "Given guidance today", "STI"), ("diagnosis", "Post-Exposure prophylaxis", "STI"),
    ("diagnosis", "Erectile Dysfunction and premature ejaculation", "ED+PE+"),
    ("diagnosis", "erectile dysfunction", "ED+"), ("diagnosis", "Premature Ejaculation", "PE+"),
    ("diagnosis", "General check", "Others"),
    ("skip", None, "Other"), ("skip", '[{"reason":"Not clinically indicated"}]', "Not clinically indicated"),
    ("skip", "Already taking it", "Already on equivalent medication"),
    ("skip", "Lifestyle changes now", "Deferred - lifestyle/therapy first"),
    ("skip", "Awaiting test", "Awaiting test results"),
    ("skip", "Known allergy", "Contraindication / adverse reaction"),
    ("skip", "Cheaper option asked", "Cost concerns"), ("skip", "Not needed", "Not required"),
    ("skip", "misc", "Other"),
    ("fallback", None, "Other"), ("fallback", "RM", "Has meds already / remaining"),
    ("fallback", "Completely treated", "Completely treated"),
    ("fallback", "RR today", "Report reading / reports normal"), ("fallback", "pt q only", "Query session"),
    ("fallback", "Reference given", "Referred out"), ("fallback", "N/E", "Not eligible"),
    ("fallback", "Counselling done", "Counseled - no treatment needed"), ("fallback", "ok", "Not specified"),
    ("fallback", "some long answer", "Other"), ("fallback", "\t\t a", "Other"),
    ("noreq", None, "Other"), ("noreq", "test results pending", "Awaiting test results"),
    ("noreq", "Counselling first", "Therapy first - meds not needed now"),
    ("noreq", "Watchful waiting", "Mild / watchful waiting"), ("noreq", "already taken", "Already has / taken meds"),
    ("noreq", "No symptoms", "No symptoms"), ("noreq", "zzz", "Other"),
    ("elig", None, "Other"), ("elig", "Phimosis seen", "Anatomical / physical concern"),
    ("elig", "NSSD", "Not a sexual-health concern"),
    ("elig", "Testing done, specialist visit", "STI referral to specialist"),
    ("elig", "Sex Ed talk", "Sex-ed / doubts only"), ("elig", "Proxy call", "Proxy consultation"),
    ("elig", "A minor", "Minor (underage)"), ("elig", "na", "Not specified"), ("elig", "something else", "Other"),
    ("tests", None, "Other"), ("tests", "Not clinically indicated", "Not clinically indicated"),
    ("tests", "Empirical treatment", "Clinical dx sufficient (empirical Rx)"),
    ("tests", "Will follow up", "Deferred to follow-up"), ("tests", "Done last month", "Recently / already done"),
    ("tests", "Cannot afford", "Affordability"), ("tests", "unsure", "Other"),
    ("therapy", None, "Other"), ("therapy", "not clinically indicated now", "Not clinically indicated"),
    ("therapy", "Reassess later", "Deferred - reassess at follow-up"),
    ("therapy", "Mild case", "Mild - meds/lifestyle enough"), ("therapy", "Out of scope", "Needs outside specialist"),
    ("therapy", "Receiving sessions", "Already in / had therapy"),
    ("therapy", "Coping support", "Beneficial but optional - supports meds"),
    ("therapy", "Meds first", "Patient prefers meds first"), ("therapy", "Privacy worry", "Skeptical / stigma concerns"),
    ("therapy", "Cannot afford", "Affordability"), ("therapy", "unsure", "Other"),
    ("optout", None, "Opt-out logged (no reason)"), ("optout", "Left the clinic early", "Left clinic before purchase chat"),
    ("optout", "Phlebo not available", "Phlebo not available"),
    ("optout", "Will buy later - no stock", "Not serviceable / no stock"),
    ("optout", "Will buy later - known pharmacy", "Will buy / do it outside"),
    ("optout", "Will buy later - budget", "Budget / price"), ("optout", "Does not believe", "Does not believe in therapy"),
    ("optout", "Side effects", "Fear of side effects"), ("optout", "Doctor said optional", "Doctor marked optional"),
    ("optout", "Try medicine a while", "Wants to try meds first"),
    ("optout", "Recent report exists", "Already has it / done recently"),
    ("optout", "At a later date", "Test due later"), ("optout", "Will buy later", "Wants to buy later / needs time"),
    ("optout", "Doesn't really want it", "Not interested / not needed"), ("optout", "hmm", "Other opt-out"),
    ("optout", "I don't think I want this", "Not interested / not needed"),
    ("optout", "want it, doesn't", "Other opt-out"),
]

SCHEMA = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("fam", T.StringType()),
                       T.StructField("text", T.StringType())])


@pytest.fixture(scope="module")
def phrases(spark):
    return spark.createDataFrame([(i, f, t) for i, (f, t, _) in enumerate(CASES)], SCHEMA)


@pytest.mark.parametrize("fam", sorted(FAMILY_LADDER))
def test_every_rung(spark, phrases, fam):
    lad = FAMILY_LADDER[fam]
    df = phrases.filter(F.col("fam") == fam)
    got_expr = {r.i: r.label for r in df.select("i", L.ladder_column(lad, "text").alias("label")).collect()}
    coded = df.select("i", L.decode_label(lad, L.ladder_code_column(lad, "text")).alias("label")).collect()
    got_code = {r.i: r.label for r in coded}
    for i, (f, text, want) in enumerate(CASES):
        if f == fam:
            assert got_expr[i] == want, (text, got_expr[i])
            assert got_code[i] == want, (text, got_code[i])


def test_codes_follow_byte_order():
    for lad in L.ALL_LADDERS.values():
        codes = L.label_codes(lad)
        assert list(codes) == sorted(codes, key=lambda s: s.encode())
    # the order traps named in the survey
    assert "Other" > "Already on equivalent medication"
    assert "Sex-ed / doubts only" > "STI referral to specialist"


def test_every_label_reachable():
    labels = {lab for f, _, lab in CASES}
    for lad in FAMILY_LADDER.values():
        assert {label for _, label in lad.rungs} | {lad.otherwise} <= labels


@pytest.mark.parametrize("name", sorted(L.ALL_LADDERS))
def test_registered_ladder_query_shows_every_label(spark, name):
    from callfunnel.plans.queries import QUERIES
    lad = L.ALL_LADDERS[name]
    rows = QUERIES[f"ladder_{name}"](spark, "/root/testdata/sf0.001").filter("part = 'answer'").select("label").distinct().collect()
    assert {r.label for r in rows} == {label for _, label in lad.rungs} | {lad.otherwise}


def test_a_text_per_alternative_pattern():
    """Between them a ladder's probes hold each of its patterns, so a dropped pattern changes a label."""
    from callfunnel.sources.fixture_text import PROBES

    def patterns(c):
        if isinstance(c, L.Has):
            return [(c, n) for n in c.needles]
        return [x for p in getattr(c, "parts", ()) for x in patterns(p)]

    for name, lad in L.ALL_LADDERS.items():
        texts = [p.lower() for p in PROBES[name] if p is not None]
        for cond, _ in lad.rungs:
            for _, needle in patterns(cond):
                first, _, then = needle.partition("%")
                assert any(first in t and then in t[t.index(first) + len(first):] for t in texts), (name, needle)


def test_two_part_patterns_are_not_a_regex(spark):
    from callfunnel.plans.queries import QUERIES
    for q in ("ladder_optout", "pred_ilike"):
        plan = QUERIES[q](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "locate" in plan and "%want" not in plan
