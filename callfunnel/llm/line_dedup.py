"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate.

Boilerplate is what a host repeats on pages that are otherwise its own: a line on more than 1 % of
them, and on 5 at least. Pages with the same text count as one page. Near copies of an article don't
count at all, so that its lines are not taken for boilerplate: a page is such a copy if more than half
of its paragraph ends (first and last five words of lines of ten words or more) are frequent on the
host, on more than half that share of all its pages. Short lines such as menus give no paragraph ends,
so they can't make a copy of a page. Lines are dropped from all pages, copies too.

A line is compared without the white space around it; lines without a word are never dropped.

Null text stays null and counts as an empty page; a null host is a host of its own. A text whose
lines all go becomes empty. Repeated rows are treated alike, an empty table gives an empty table,
other columns pass through. Lines are told apart by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import drop_stored, stored, whole, words

END_WORDS = 5
AROUND = " \t\r\x0b\x0c"


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(AROUND))


def line_keys(text: Column) -> Column:
    """Distinct hashes of the trimmed lines that hold a word."""
    held = F.filter(F.transform(F.split(text, "\n"), bare), lambda line: line != "")
    return F.array_distinct(F.transform(held, lambda line: F.xxhash64(line)))


def paragraph_ends(text: Column) -> Column:
    """Distinct hashes of the first and of the last five words of every line of ten words or more."""
    long = F.filter(F.transform(F.split(text, "\n"), words), lambda ws: F.size(ws) >= 2 * END_WORDS)
    ends = F.transform(long, lambda ws: F.array(*[F.xxhash64(F.slice(ws, at, END_WORDS)) for at in (1, -END_WORDS)]))
    return F.array_distinct(F.flatten(ends))


def frequent(pages: DataFrame, keys: str, max_ratio: float, min_pages: int, name: str) -> DataFrame:
    """(host, `name`): per host the keys on more than `max_ratio` of the `pages` (host, `keys`), and on `min_pages`.

    A host has at most (mean distinct keys per page) / max_ratio such keys, so the array is bounded.
    Keys and hosts are combined before each shuffle.
    """
    counts = (pages.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= min_pages))
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("total"))
    found = counts.join(totals, F.col("host").eqNullSafe(F.col("of"))).filter(F.col("n") > F.col("total") * max_ratio)
    return found.groupBy("host").agg(F.array_sort(F.collect_set("key")).alias(name))


def distinct_pages(docs: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """(host, ends, keys), one row per distinct text of a host; texts are read once and only hashes leave the task."""
    text = docs.select(docs[host_col].cast("string").alias("host"), whole(docs[text_col]).alias("text"))
    hashes = text.select("host", F.xxhash64("text").alias("page"), paragraph_ends(F.col("text")).alias("ends"),
                         line_keys(F.col("text")).alias("keys"))
    return hashes.dropDuplicates(["host", "page"]).select("host", "ends", "keys")


def boilerplate(docs: DataFrame, host_col: str, text_col: str, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): per host the hashes of lines on more than `max_ratio` of its pages that aren't near copies."""
    pages = stored(distinct_pages(docs, host_col, text_col), "pages")
    common = stored(frequent(pages, "ends", max_ratio / 2, min_pages, "common"), "ends")
    of = common.select(F.col("host").alias("of"), "common")
    copy = F.col("common").isNotNull() & (2 * F.size(F.array_intersect("ends", "common")) > F.size("ends"))
    own = pages.join(of, F.col("host").eqNullSafe(F.col("of")), "left").filter(~copy).select("host", "keys")
    known = stored(frequent(own, "keys", max_ratio, min_pages, "lines"), "boilerplate")
    drop_stored(docs.sparkSession, pages, common)
    return known


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = 0.01,
                     min_pages: int = 5) -> DataFrame:
    """`docs` with boilerplate lines taken out of `text_col`.

    The table of lines is a written one, so the planner knows its size: a small one is broadcast,
    a large one is joined by host, where AQE splits a hot host.
    """
    known = boilerplate(docs, host_col, text_col, max_ratio, min_pages).select(F.col("host").alias("_host"), F.col("lines").alias("_lines"))
    kept = F.array_join(F.filter(F.split(docs[text_col], "\n"), lambda line: ~F.array_contains(
        known["_lines"], F.xxhash64(bare(line)))), "\n")
    names = [f"`{c}`" for c in docs.columns]
    out = docs.join(known, docs[host_col].cast("string").eqNullSafe(known["_host"]), "left")
    return out.select(*[F.when(known["_lines"].isNull(), docs[text_col]).otherwise(kept).alias(text_col)
                        if c == text_col else docs[n] for c, n in zip(docs.columns, names)])


def line_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lines before, lines dropped, SHA-256 of the text that is left."""
    both = docs.select("doc_id", "source", F.col("text").alias("text"), whole(F.col("text")).alias("before"))
    out = drop_boilerplate(both.select("doc_id", "source", "before", "text"))
    lines = lambda t: F.size(F.split(t, "\n"))
    left = whole(F.col("text"))
    return out.select("doc_id", lines(F.col("before")).cast("long").alias("n_lines"),
                      (F.length("before") - F.length(left)).cast("long").alias("n_chars_dropped"),
                      F.sha2(left, 256).alias("text_sha256"))


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t),
k AS (SELECT l.r, i, line, source, text, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM l JOIN t ON t.r = l.r),
n AS (SELECT source, count(DISTINCT text) AS total FROM t GROUP BY source),
g AS (SELECT r, source, text, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM k),
e AS (SELECT DISTINCT r, source, text, unnest([array_to_string(ws[1:5], ' '), array_to_string(ws[len(ws) - 4:len(ws)], ' ')]) AS ending FROM g WHERE len(ws) >= 10),
f AS (SELECT e.source, ending FROM e JOIN n ON e.source IS NOT DISTINCT FROM n.source
      GROUP BY e.source, ending, total HAVING count(DISTINCT text) >= 5 AND count(DISTINCT text) > total * (CAST(0.01 AS DOUBLE) / 2)),
copies AS (SELECT e.r FROM e LEFT JOIN f ON e.source IS NOT DISTINCT FROM f.source AND e.ending = f.ending
           GROUP BY e.r HAVING 2 * count(f.ending) > count(*)),
c AS (SELECT source, bare, count(DISTINCT text) AS n FROM k WHERE bare <> '' AND r NOT IN (SELECT r FROM copies) GROUP BY source, bare),
p AS (SELECT source, count(DISTINCT text) AS total FROM t WHERE r NOT IN (SELECT r FROM copies) GROUP BY source),
b AS (SELECT c.source, bare FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE n >= 5 AND n > total * CAST(0.01 AS DOUBLE)),
kept AS (SELECT k.r, i, line FROM k WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.source IS NOT DISTINCT FROM k.source AND b.bare = k.bare)),
j AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text FROM kept GROUP BY r)
SELECT doc_id, CAST(len(string_split(t.text, chr(10))) AS BIGINT) AS n_lines,
       CAST(length(t.text) - length(coalesce(j.text, '')) AS BIGINT) AS n_chars_dropped, sha256(coalesce(j.text, '')) AS text_sha256
FROM t LEFT JOIN j ON j.r = t.r
"""
