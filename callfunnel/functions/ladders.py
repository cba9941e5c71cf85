"""Ordered rule ladders over free text: first matching rung wins.

A ladder is data (rungs of conditions and labels). `ladder_column` turns it into
one `CASE WHEN` Column evaluated inside whole-stage codegen. No UDF anywhere.

Matching is case-insensitive substring search. The text is lower-cased once per
row and every rung tests the lowered copy, so a 15-rung ladder costs one
`lower()` plus cheap `contains` checks. A NULL text matches no rung and falls to
the ELSE label unless the ladder has an explicit NULL rung.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------- conditions
@dataclass(frozen=True)
class Has:
    """Any needle is a case-insensitive substring (`%` inside = any run of chars)."""
    needles: tuple

    def __init__(self, *needles: str):
        object.__setattr__(self, "needles", tuple(n.lower() for n in needles))


@dataclass(frozen=True)
class Trimmed:
    """lower(trim(text)) equals one of the values (trim strips spaces only)."""
    values: tuple

    def __init__(self, *values: str):
        object.__setattr__(self, "values", tuple(values))


@dataclass(frozen=True)
class TrimmedPrefix:
    """lower(trim(text)) starts with one of the prefixes."""
    prefixes: tuple

    def __init__(self, *prefixes: str):
        object.__setattr__(self, "prefixes", tuple(prefixes))


@dataclass(frozen=True)
class ShortTrimmed:
    """length(trim(text)) <= n."""
    n: int


@dataclass(frozen=True)
class IsNull:
    pass


@dataclass(frozen=True)
class AnyOf:
    parts: tuple

    def __init__(self, *parts):
        object.__setattr__(self, "parts", tuple(parts))


@dataclass(frozen=True)
class AllOf:
    parts: tuple

    def __init__(self, *parts):
        object.__setattr__(self, "parts", tuple(parts))


@dataclass(frozen=True)
class Ladder:
    name: str
    rungs: tuple          # ((condition, label), ...), first match wins
    otherwise: str


# ---------------------------------------------------------------- fixed values
# FIXED VALUES: the rule ladders below (patterns, labels, rung order, ELSE labels)
# must stay exactly as written for results to match the analysed pipeline.
# Patterns are case-insensitive substrings; `%` inside a pattern matches any run.

OPTOUT = Ladder("optout", (
    (IsNull(), "Opt-out logged (no reason)"),
    (Has("left the clinic"), "Left clinic before purchase chat"),
    (Has("phlebo"), "Phlebo not available"),
    (Has("unservi", "not servi", "no stock", "not available"), "Not serviceable / no stock"),
    (Has("outside", "known pharmacy", "known lab", "preferred lab", "elsewhere"), "Will buy / do it outside"),
    (Has("budget", "price", "money", "afford", "financial"), "Budget / price"),
    (Has("believe"), "Does not believe in therapy"),
    (Has("side effect"), "Fear of side effects"),
    (Has("optional"), "Doctor marked optional"),
    (Has("check if medicine", "medicines work", "medicine work", "try medicine", "few days", "helps"),
     "Wants to try meds first"),
    (Has("already", "recent report", "recently"), "Already has it / done recently"),
    (Has("due date", "later date"), "Test due later"),
    (Has("later", "time to think", "discuss", "second opinion", "decide"), "Wants to buy later / needs time"),
    (Has("not interested", "not needed", "not required", "are needed", "doesn%want", "don%want"),
     "Not interested / not needed"),
), "Other opt-out")

DIAGNOSIS = Ladder("diagnosis", (
    (Has("Mental Health Concern"), "MH"),
    (Has("Genito Urinary Infection", "GUI", "Post-Exposure"), "STI"),
    (AllOf(Has("Premature Ejaculation"), Has("Erectile Dysfunction")), "ED+PE+"),
    (Has("Erectile Dysfunction"), "ED+"),
    (Has("Premature Ejaculation"), "PE+"),
), "Others")

MEDS_SKIP = Ladder("meds_skip", (
    (Has("not clinically indicated"), "Not clinically indicated"),
    (Has("already on equivalent", "already"), "Already on equivalent medication"),
    (Has("deferred", "lifestyle", "therapy-first", "therapy advised"), "Deferred - lifestyle/therapy first"),
    (Has("awaiting test", "test result", "waiting"), "Awaiting test results"),
    (Has("contraindication", "allergy", "adverse", "side effect"), "Contraindication / adverse reaction"),
    (Has("cost", "expense", "cheaper"), "Cost concerns"),
    (Has("not required", "not needed", "not requiring"), "Not required"),
), "Other")

NO_RX_NEEDED = Ladder("no_rx_needed", (
    (AnyOf(Has("remain", "has med", "have med", "already", "medicines are there", "rx complete"),
           Trimmed("has", "rm")), "Has meds already / remaining"),
    (Has("treat"), "Completely treated"),
    (AnyOf(Has("report"), TrimmedPrefix("rr"), Has("wnl", "normal", "negative")),
     "Report reading / reports normal"),
    (AnyOf(TrimmedPrefix("pq"), Has("quer"), TrimmedPrefix("pt q")), "Query session"),
    (Has("refer"), "Referred out"),
    (AnyOf(Has("eligib"), Trimmed("ne", "n/e")), "Not eligible"),
    (Has("counsel"), "Counseled - no treatment needed"),
    (ShortTrimmed(3), "Not specified"),
), "Other")

MEDS_NOT_REQUIRED = Ladder("meds_not_required", (
    (Has("awaiting test", "test result"), "Awaiting test results"),
    (Has("therapy", "counsel"), "Therapy first - meds not needed now"),
    (Has("mild", "watchful", "situational"), "Mild / watchful waiting"),
    (Has("already"), "Already has / taken meds"),
    (Has("no symptom"), "No symptoms"),
), "Other")

ELIGIBILITY = Ladder("eligibility", (
    (Has("anatomical", "physical", "phimosis"), "Anatomical / physical concern"),
    (Has("not a sexual health", "nssd", "other issues"), "Not a sexual-health concern"),
    (AllOf(Has("sti"), Has("referral", "specialist")), "STI referral to specialist"),
    (Has("sex ed", "education", "doubt", "quer", "myth"), "Sex-ed / doubts only"),
    (Has("proxy"), "Proxy consultation"),
    (Has("minor"), "Minor (underage)"),
    (ShortTrimmed(3), "Not specified"),
), "Other")

TESTS = Ladder("tests", (
    (Has("not clinically indicated"), "Not clinically indicated"),
    (Has("empirical", "diagnosis sufficient"), "Clinical dx sufficient (empirical Rx)"),
    (Has("defer", "follow"), "Deferred to follow-up"),
    (Has("already", "recently", "done"), "Recently / already done"),
    (Has("afford"), "Affordability"),
), "Other")

THERAPY = Ladder("therapy", (
    (Has("not clinically indicated"), "Not clinically indicated"),
    (Has("defer", "reassess", "follow"), "Deferred - reassess at follow-up"),
    (Has("mild"), "Mild - meds/lifestyle enough"),
    (Has("scope", "specialist"), "Needs outside specialist"),
    (Has("already", "receiving", "elsewhere", "pending session"), "Already in / had therapy"),
    (Has("supports", "strengthens", "sustains", "relationship", "couple", "coping", "anxiety", "relapse"),
     "Beneficial but optional - supports meds"),
    (Has("medication first", "meds first"), "Patient prefers meds first"),
    (Has("skeptical", "stigma", "privacy"), "Skeptical / stigma concerns"),
    (Has("afford"), "Affordability"),
), "Other")

# FIXED VALUES: form question titles that carry each reason.
TITLE_MEDS_SKIP = "Reason for not prescribing a recommended medication"
TITLES_NO_RX_NEEDED = ("Why does the patient not need a prescription?",
                       "What is the reason for the patient not needing a prescription?")
TITLE_MEDS_NOT_REQUIRED = "Why are medications not required for this patient?"
TITLE_ELIGIBILITY = "What is the reason for non-eligibility?"
TITLE_TESTS = "Why were no diagnostic tests recommended?"
TITLES_THERAPY = ("Why is therapy not being recommended?",
                  "Why is therapy beneficial but not essential for this patient?",
                  "Why doesn't the patient believe in therapy?")
# all nine reason titles, in the order the reason scan lists them
REASON_TITLES = (TITLE_MEDS_SKIP, TITLE_MEDS_NOT_REQUIRED, TITLE_ELIGIBILITY) + TITLES_NO_RX_NEEDED + (
    TITLE_TESTS,) + TITLES_THERAPY
# the diagnosis question is found by this title substring
DIAGNOSIS_TITLE_NEEDLE = "diagnosis"
# encounter type substring marking the merged prescription encounter
MERGED_RX_NEEDLE = "merged-rx"

# FIXED VALUES: call types, statuses and call-type labels.
CALL_STATUSES = ("COMPLETED", "RECONSULTED")
CALL_TYPE_NAMES = ("Screening Call", "Follow Up", "Report Reading", "Patient Queries")
CTYPE_ORDER = ("Offline SC", "Online SC", "FU", "PQ", "RR")
DIAG_ORDER = ("MH", "STI", "ED+", "PE+", "ED+PE+", "Others")

ALL_LADDERS = {lad.name: lad for lad in
               (OPTOUT, DIAGNOSIS, MEDS_SKIP, NO_RX_NEEDED, MEDS_NOT_REQUIRED, ELIGIBILITY, TESTS, THERAPY)}


# ---------------------------------------------------------------- Spark SQL text
# Large CASE ladders are handed to Catalyst as one `F.expr` string: one JVM round
# trip instead of one per `when`/`contains`/`lit`, and the same expression tree.
def spark_str(s: str) -> str:
    """A Spark SQL string literal (backslash escapes)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _needle_spark(n: str, low: str) -> str:
    """Substring test; `a%b` = an `a` with a `b` somewhere after it.

    The two-part form is written as two linear `locate` scans (first `a`, then
    `b` after it) instead of a backtracking LIKE regex over long texts; taking
    the first `a` leaves the most room for `b`, so the test is exact.
    """
    parts = n.split("%")
    if len(parts) == 1:
        return f"{low} LIKE {spark_str('%' + n + '%')}"
    if len(parts) == 2 and all(parts):
        a, b = parts
        first = f"locate({spark_str(a)}, {low})"
        return f"({first} > 0 AND locate({spark_str(b)}, {low}, {first} + {len(a)}) > 0)"
    return f"{low} LIKE {spark_str('%' + n + '%')}"


def _cond_spark(cond, raw: str, low: str) -> str:
    if isinstance(cond, Has):
        return "(" + " OR ".join(_needle_spark(n, low) for n in cond.needles) + ")"
    if isinstance(cond, Trimmed):
        return f"lower(trim({raw})) IN (" + ", ".join(spark_str(v) for v in cond.values) + ")"
    if isinstance(cond, TrimmedPrefix):
        return "(" + " OR ".join(f"lower(trim({raw})) LIKE {spark_str(p + '%')}" for p in cond.prefixes) + ")"
    if isinstance(cond, ShortTrimmed):
        return f"length(trim({raw})) <= {cond.n}"
    if isinstance(cond, IsNull):
        return f"{raw} IS NULL"
    if isinstance(cond, AnyOf):
        return "(" + " OR ".join(_cond_spark(p, raw, low) for p in cond.parts) + ")"
    if isinstance(cond, AllOf):
        return "(" + " AND ".join(_cond_spark(p, raw, low) for p in cond.parts) + ")"
    raise TypeError(f"unknown rule condition {cond!r}")


def _ladder_expr(ladder: Ladder, text: str, lowered: str | None, label_sql) -> Column:
    raw = _ident(text)
    low = _ident(lowered) if lowered else f"lower({raw})"
    whens = " ".join(f"WHEN {_cond_spark(c, raw, low)} THEN {label_sql(label)}" for c, label in ladder.rungs)
    return F.expr(f"CASE {whens} ELSE {label_sql(ladder.otherwise)} END")


# ---------------------------------------------------------------- Spark side
def ladder_column(ladder: Ladder, text: str, lowered: str | None = None) -> Column:
    """One CASE WHEN column for `ladder` over the string column named `text`.

    Pass `lowered` (the name of a column holding lower(text)) to share one
    lower-casing between several ladders over the same text.
    """
    return _ladder_expr(ladder, text, lowered, spark_str)


def has_pattern(pattern: str, lowered: str) -> Column:
    """Whether the lower-case column holds `pattern` (`a%b`: an `a` and, after it, a `b`)."""
    return F.expr(_needle_spark(pattern.lower(), _ident(lowered)))


def call_type_column(type_name, location, online_locations) -> Column:
    """Call-type label: screening calls split by location, others by type name."""
    t = F.col(type_name) if isinstance(type_name, str) else type_name
    loc = F.col(location) if isinstance(location, str) else location
    return (F.when((t == "Screening Call") & loc.isin(*online_locations), "Online SC")
            .when(t == "Screening Call", "Offline SC")
            .when(t == "Follow Up", "FU")
            .when(t == "Patient Queries", "PQ")
            .otherwise("RR"))


# ---------------------------------------------------------------- integer-coded labels
def label_codes(ladder: Ladder) -> tuple:
    """All labels of a ladder in byte order; a label's code is its position.

    MAX over codes picks the same label as MAX over the label strings (byte-wise
    comparison), but aggregates in a fixed-width hash buffer instead of forcing a
    sort-based aggregate.
    """
    labels = {label for _, label in ladder.rungs} | {ladder.otherwise}
    return tuple(sorted(labels, key=lambda s: s.encode("utf-8")))


def ladder_code_column(ladder: Ladder, text: str, lowered: str | None = None) -> Column:
    """Like `ladder_column`, but yields the label's integer code."""
    codes = {label: i for i, label in enumerate(label_codes(ladder))}
    return _ladder_expr(ladder, text, lowered, lambda label: str(codes[label]))


def decode_label(ladder: Ladder, code) -> Column:
    """Integer code -> label (NULL stays NULL)."""
    c = F.col(code) if isinstance(code, str) else code
    # guard NULL explicitly: element_at with a NULL index must not be relied on
    arr = F.expr("array(" + ", ".join(spark_str(x) for x in label_codes(ladder)) + ")")
    return F.when(c.isNotNull(), F.element_at(arr, c + 1))
