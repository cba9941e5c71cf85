"""Quality rules as a short-circuit cascade: rules run in the order of rejections per second of cost.

Every rule is one SQL expression on a text and its words, which are split once for all rules.
`order_rules` times each rule and counts its rejections on a bounded sample, and sorts by rejection
per cost; `cascade` then evaluates the rules one by one and stops at the first that rejects. The
order changes the cost, never the verdict.

Null text counts as empty: no words, so `min_words` rejects it. Other columns are not read; extra
columns of any name pass through. Repeated rows are judged alike, an empty table gives an empty
table. Windows of 8 words are compared by a 64-bit hash of the words.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import WHITE, let, whole

WINDOW = 8
SYMBOL = "[#*$%&|<>]"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[ {WHITE}]"), "")


def symbol_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOL)).cast("long")


def word_chars(ws: Column) -> Column:
    return F.length(F.array_join(ws, "")).cast("long")


def word_lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" " + WHITE)) != "")


def dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def adjacent_repeats(ws: Column) -> Column:
    """Words equal to the word before them."""
    return F.size(F.filter(ws, lambda w, i: w == F.get(ws, i - 1))).cast("long")


def repeat_words(ws: Column) -> Column:
    """Words inside windows of 8 words that occur twice or more, first occurrence included."""
    none = F.lit(0).cast("long")

    def covered(starts: Column) -> Column:
        state = F.struct(none.alias("n"), none.alias("end"))
        return F.aggregate(
            starts, state,
            lambda acc, at: F.struct((acc["n"] + F.least(F.lit(WINDOW), at + WINDOW - acc["end"])).alias("n"),
                                     (at + WINDOW).alias("end")),
            lambda acc: acc["n"])

    def of_sorted(pairs: Column) -> Column:
        def twice(pair: Column, k: Column) -> Column:
            same = lambda other: F.coalesce(other["h"] == pair["h"], F.lit(False))
            return same(F.get(pairs, k - 1)) | same(F.get(pairs, k + 1))

        return covered(F.sort_array(F.transform(F.filter(pairs, twice), lambda p: p["at"])))

    def of_hashes(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("at")))
        return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none)
                .otherwise(let(F.sort_array(pairs), of_sorted)))

    def doubled(hashes: Column, span: int) -> Column:
        """Hashes of spans twice as long, from those of neighbouring spans."""
        return let(hashes, lambda h: F.transform(F.slice(h, 1, F.size(h) - span), lambda v, i: F.xxhash64(v, F.get(h, i + span))))

    hashes, span = F.transform(ws, lambda w: F.xxhash64(w)), 1
    while span < WINDOW:
        hashes, span = doubled(hashes, span), 2 * span
    return F.when(F.size(ws) < WINDOW + 1, none).otherwise(let(hashes, of_hashes))


@dataclass(frozen=True)
class Rule:
    """`rejects(text, words)`: an expression over a non-null text and its words, true where the rule rejects."""

    name: str
    rejects: Callable[[Column, Column], Column]


def base_rules(min_words: int = 20, max_repeat_pct: int = 30) -> list[Rule]:
    return [
        Rule("min_words", lambda t, w: F.size(w) < min_words),
        Rule("repeated_windows", lambda t, w: 100 * repeat_words(w) > max_repeat_pct * F.size(w)),
    ]


def method_rules(max_symbol_pct: int = 25, max_dup_line_pct: int = 50, max_adjacent_pct: int = 30,
                 min_word_chars: int = 2, max_word_chars: int = 25) -> list[Rule]:
    """Rules beside the base: symbols per word, repeated lines, stuttering, mean word length."""
    return [
        Rule("symbols", lambda t, w: 100 * symbol_count(t) > max_symbol_pct * F.size(w)),
        Rule("dup_lines", lambda t, w: let(word_lines(t), lambda x: 100 * dup_lines(x) > max_dup_line_pct * F.size(x))),
        Rule("stutter", lambda t, w: 100 * adjacent_repeats(w) > max_adjacent_pct * F.size(w)),
        Rule("word_length", lambda t, w: let(word_chars(w), lambda n: (n < min_word_chars * F.size(w))
                                             | (n > max_word_chars * F.size(w)))),
    ]


def some_texts(docs: DataFrame, text_col: str, sample_files: int) -> DataFrame:
    """(t): the texts of `sample_files` files spread over a table of Parquet files, of all rows of any other frame."""
    files = sorted(docs.inputFiles())
    if len(files) > sample_files and all(f.endswith(".parquet") for f in files):
        chosen = docs.sparkSession.read.parquet(*[files[i * len(files) // sample_files] for i in range(sample_files)])
        if text_col in chosen.columns:
            return chosen.select(whole(chosen[text_col]).alias("t"))
    return docs.select(whole(docs[text_col]).alias("t"))


def order_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_files: int = 4,
                sample_rows: int = 1000) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, rejected share) by rejection per second, best first.

    The sample is bounded: about `sample_rows` rows out of at most `sample_files` files, spread
    over the table's files; for a table that isn't made of Parquet files, out of the whole table.
    Seconds are the better of two runs, less those of a rule that looks at nothing.
    """
    text = some_texts(docs, text_col, sample_files)
    total = text.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    sample = (text if total <= sample_rows else text.sample(sample_rows / total, seed=7)).coalesce(8).persist()

    def run(rule: Rule) -> tuple[float, float]:
        rejected = F.coalesce(let(words(F.col("t")), lambda w: rule.rejects(F.col("t"), w)), F.lit(False))
        began = time.perf_counter()
        share = sample.agg(F.avg(rejected.cast("double"))).first()[0]
        return time.perf_counter() - began, float(share or 0.0)

    try:
        sample.agg(F.sum(F.length("t"))).first()  # fills the cache before anything is timed
        nothing = Rule("nothing", lambda t, w: F.size(w) < 0)
        floor, *timed = [min(run(rule), run(rule)) for rule in [nothing, *rules]]
    finally:
        sample.unpersist()
    measured = [(rule, max(seconds - floor[0], 1e-3), share) for rule, (seconds, share) in zip(rules, timed)]
    return sorted(measured, key=lambda m: -m[2] / m[1])


def first_rejecting(text: Column, ws: Column, rules: list[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects; CASE stops there, so later rules are not evaluated."""
    case = F.lit(None).cast("string")
    for rule in reversed(rules):
        case = F.when(rule.rejects(text, ws), F.lit(rule.name)).otherwise(case)
    return case


def cascade(text: Column, rules: list[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects `text`; null if none does."""
    return let(words(text), lambda w: first_rejecting(text, w, rules))


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass every rule (default: base and method rules), columns unchanged."""
    rules = base_rules() + method_rules() if rules is None else rules
    ordered = [r for r, _, _ in order_rules(docs, rules, text_col)]
    return docs.filter(cascade(whole(docs[text_col]), ordered).isNull())


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base figures of every text, the base verdict, and the cascade's verdict on what the base passes."""
    ordered = [r for r, _, _ in order_rules(docs, method_rules(), text_col)]
    text = docs.select(docs[id_col].alias("doc_id"), whole(docs[text_col]).alias("t"))
    def judged(w: Column) -> Column:
        counts = F.struct(F.size(w).cast("long").alias("n_words"), word_chars(w).alias("word_chars"),
                          repeat_words(w).alias("n_repeat_words"))

        def verdict(c: Column) -> Column:
            failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
            kept = F.when(failed, F.lit(False)).otherwise(first_rejecting(F.col("t"), w, ordered).isNull())
            return F.struct(c.alias("counts"), failed.alias("base_failed"), kept.alias("kept"))

        return let(counts, verdict)

    out = text.select("doc_id", "t", let(words(F.col("t")), judged).alias("f"))
    return out.select("doc_id", "f.counts.n_words", "f.counts.word_chars", symbol_count(F.col("t")).alias("n_symbols"),
                      dup_lines(word_lines(F.col("t"))).alias("n_dup_lines"), "f.counts.n_repeat_words",
                      "f.base_failed", "f.kept")


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
win AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i,
               unnest(list_transform(range(1, len(ws) - 6), lambda j: array_to_string(ws[j:j+7], ' '))) AS g FROM w WHERE len(ws) >= 8),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, range(0, 8) AS z(k) GROUP BY r),
m AS (SELECT w.r, doc_id, text, ws, ls, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
             len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_adjacent
      FROM w LEFT JOIN cov ON cov.r = w.r),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (100 * n_symbols > 25 * n_words OR 100 * n_dup_lines > 50 * len(ls)
            OR 100 * n_adjacent > 30 * n_words OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM v
"""
