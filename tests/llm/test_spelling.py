"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from data import rows, table

from callfunnel.llm import spelling


def brute(data):
    counts = Counter()
    for doc, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    alphabet = {c for w in n for c in w}

    def near(w):
        out = {w[:i] + w[i + 1:] for i in range(len(w))}
        out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet}
        out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        return sorted((x for x in out if x in n and x != w), key=lambda x: (-n[x], x))

    form = {w: (f[0] if (f := near(w)) and n[f[0]] >= 10 * n[w] else None) for w in n}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near(w)), n[form[w]] if form[w] else None))
    return out


def corpus():
    """Few letters, so words are near in many ways, runs of one letter, accents, chains of forms."""
    rng = random.Random(8)
    words = ["".join(rng.choice("aabbé") for _ in range(rng.randint(6, 9))) for _ in range(900)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "baaaaaaa"]
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    out += [(500 + i, " ".join(["Übermut"] * (300 if i == 0 else 12) + ["Übermüt"] * (25 if i == 1 else 0) + ["Übermütx"])) for i in range(2)]
    return out + [r[:2] for r in rows()] + [(900, "Straßen-straßen STRASSEN × weiß÷weiß weiß÷weiß word_word_longer word_longer longers")]


def test_variants_equal_brute_force(spark):
    data = corpus()
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = [tuple(r) for r in spelling.variants(docs).collect()]
    assert len(got) == len(set(got))
    want = brute(data)
    assert set(got) == want
    assert any(r[1] and r[1] != r[2] for r in want) and any(r[4] > 5 for r in want)  # chains, and many near words


def test_over_many_partitions(spark):
    data = corpus()
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        docs = spark.createDataFrame(data, "doc_id long, text string").repartition(17)
        assert {tuple(r) for r in spelling.variants(docs).collect()} == brute(data)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_general_words(spark):
    """Any strings, one of them empty; each pair once, also where a doubled letter can go in two ways."""
    words = spark.createDataFrame([("", 4), ("a", 3), ("aa", 2), ("aab", 9), ("ab", 1), ("日本", 5), ("日本語", 1)], "word string, n long")
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(words).collect()}
    assert got == {"a": (2, 2, "aa"), "aa": (3, 9, "aab"), "aab": (2, 2, "aa"), "ab": (3, 9, "aab"), "日本": (1, 1, "日本語"), "日本語": (1, 5, "日本")}


def test_awkward_and_empty_tables(spark):
    got = spelling.variants(table(spark))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute([r[:2] for r in rows()])
    assert spelling.variants(table(spark, [])).collect() == []
