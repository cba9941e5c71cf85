"""Spelling variants by a permuterm index: words that differ by one inserted, deleted or replaced character.

A word ends in a terminator and is rotated to every position. Rotated so that the edited character
comes last, a word reads `after + END + before + edited`: words that differ in that character alone
share everything before it, and the word that lacks the character is that shared prefix itself, a
rotation of its own. So all rotations, keyed by the prefix that skips the edited character, are
range-sorted over the cluster and scanned once; equal prefixes are neighbours. A prefix holds at
most one row per character of the alphabet and one word without it, however common a word is.

Of a run of equal characters the first alone stands for the deletion, so every pair of near words
meets exactly once. The scan gives out each word's number of near words and the best of them, one
row per word and prefix, never the pairs; these are combined per word.

`form` is a word's near word of largest n (ties: first in code-point order) if that n is at least
`ratio` times the word's own; `root` follows forms to the last by pointer doubling. Forms grow by
`ratio` a step, so chains are short.

Null text counts as empty. A row with a null id is counted as it stands (no character is deleted
from its runs). Repeated rows count as often as they stand. An empty table gives no words. Columns
other than id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import drop_stored, stored

END = "\x00"  # the terminator; words don't hold it
HELD_WORDS = 200_000  # distinct words counted in a worker before they are handed on


def changed(run: str, start: int, every: int) -> str:
    """The run, without one character where `every` divides its checksum (begun with that of `<doc_id>:`)."""
    h = zlib.crc32(run.encode("utf-8", "surrogatepass"), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7,
                least: int = 2, every: int = 31) -> DataFrame:
    """(word, n): lower-cased runs of letters of `least_length` or more that stand `least` times or more in all texts."""
    find = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}").findall

    def run(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not text:
                        continue
                    start = None if doc is None else zlib.crc32(f"{doc}:".encode())
                    for word, n in Counter(find(text.encode().lower().decode())).items():  # of bytes, only A-Z are lower-cased
                        if start is not None:
                            word = changed(word, start, every)
                        if len(word) >= least_length:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        if held:
            yield out()

    found = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, n): every rotation keyed without its last character, and whole with an empty `edited`."""
    word, last = F.col("word"), F.length("word")
    left = lambda i: F.substr(word, F.lit(1), i)
    right = lambda i: F.substr(word, i + 1, last)
    turned = lambda i, skip: F.concat(right(i + skip), F.lit(END), left(i))
    without = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.struct(turned(i, 1).alias("prefix"), F.substr(word, i + 1, F.lit(1)).alias("edited")))
    whole = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(turned(i, 0).alias("prefix"), F.lit("").alias("edited")))
    return words.filter(last > 0).select(F.explode(F.concat(without, whole)).alias("r"), "n").select("r.prefix", "r.edited", "n")


def group_best(prefix: str, edited: list[str], counts: list[int]):
    """(word, near, best_n, best) for the words of one prefix."""
    after, before = prefix.split(END)
    skip = before[-1:]  # the same character again: the deletion is that of the one before
    longer, lacking = [], None
    for x, n in zip(edited, counts):
        if x:
            longer.append((-n, before + x + after, x != skip))
        else:
            lacking = (-n, before + after)
    longer.sort()
    for k, (_, word, first) in enumerate(longer):
        near = len(longer) - 1
        best = longer[1 - min(k, 1)][:2] if near else None
        if lacking and first:
            near += 1
            best = min(best, lacking) if best else lacking
        if near:
            yield word, near, -best[0], best[1]
    if lacking:
        firsts = [w[:2] for w in longer if w[2]]
        if firsts:
            yield lacking[1], len(firsts), -firsts[0][0], firsts[0][1]


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for every word of `words` (word, n; distinct) that has near words."""
    def of(table: pa.Table, starts: np.ndarray):
        sizes = np.diff(starts)
        crowded = np.flatnonzero(sizes > 1)
        if not len(crowded):
            return
        rows = np.concatenate([np.arange(starts[g], starts[g + 1]) for g in crowded])
        some = table.take(pa.array(rows))
        prefix, edited, n = (some[c].to_pylist() for c in ("prefix", "edited", "n"))
        out, at = [], 0
        for size in sizes[crowded].tolist():
            out += group_best(prefix[at], edited[at:at + size], n[at:at + size])
            at += size
        if out:
            word, near, best_n, best = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(best_n, pa.int64()),
                                              pa.array(best, pa.string())], ["word", "near", "best_n", "best"])

    def scan(batches):
        """Groups of equal prefixes, whole; the last one of a batch waits for the next batch."""
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            prefix = rows["prefix"].combine_chunks()
            starts = np.append(0, np.flatnonzero(pc.not_equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False)) + 1)
            held = rows.slice(int(starts[-1]))
            yield from of(rows, starts)
        if held is not None:
            yield from of(held, np.array([0, held.num_rows]))

    order = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "edited")
    found = order.mapInArrow(scan, "word string, near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("k"), "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for `forms` (word, form): the last form reached, each round twice as far."""
    spark = forms.sparkSession
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = stored(now.join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left"), "hops")
        if step.filter("next IS NOT NULL").isEmpty():
            drop_stored(spark, step)
            return now
        old, now = now, stored(step.select("word", F.coalesce("next", "root").alias("root")), "roots")
        drop_stored(spark, old, step)


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 10, **counting) -> DataFrame:
    """Per word of the texts: word, form, root, n, n_near, form_n."""
    words = stored(word_counts(docs, id_col, text_col, **counting), "words")
    best = stored(words.join(near_words(words), "word", "left"), "near")
    is_form = F.col("best_n") >= ratio * F.col("n")
    forms = best.filter(is_form).select("word", F.col("best").alias("form"))
    root = roots(forms)
    drop_stored(docs.sparkSession, words)
    return best.join(root, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
