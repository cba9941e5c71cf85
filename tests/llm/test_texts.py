"""Operators on texts against brute force, on awkward rows and on an empty table."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from data import SCHEMA, rows, table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callfunnel.llm import bpe, html_text, license_scan, line_dedup, mixing, pii, quality_classifier, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def key(x):
    return repr(x)


# ------------------------------------------------------------------ quality rules
def figures(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    covered = {i + j for i in range(len(ws) - 7) if windows[tuple(ws[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_figures(spark, docs):
    extra = [(200, "a b c d e f g h i " * 5, *[None] * 7), (201, "one\ntwo\none\n\n two\nthree #$ x", *[None] * 7),
             (202, "p q r s t u v w x " + "z " * 9 + "p q r s t u v w x", *[None] * 7)]
    data = rows() + extra
    got = sorted(map(key, (tuple(r)[:6] for r in quality_rules.quality_rules(table(spark, data)).collect())))
    want = sorted(key((d[0], *figures(d[1]))) for d in data)
    assert got == want


def test_quality_verdicts(spark):
    clean = " ".join(f"word{i} and" for i in range(60))
    data = [(1, clean), (2, "few words"), (3, "a b c d e f g h " * 20), (4, " ".join(f"w{i}%%%" for i in range(50))), (5, "This " * 8 + clean),
            (6, " ".join(f"same{i}" for i in range(25) for _ in range(4))), (7, "\n".join(["one line"] * 30)), (8, None)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.quality_rules(spark.createDataFrame(data, "doc_id int, text string")).collect()}
    assert got[1] == got[5] == (False, True)
    assert {i: got[i][1] for i in (2, 3, 4, 6, 7, 8)} == dict.fromkeys((2, 3, 4, 6, 7, 8), False)
    assert got[2][0] and got[3][0] and not got[4][0]


def test_rules_take_files_that_are_not_parquet(spark, tmp_path):
    docs = table(spark).select("doc_id", "text", "_host")
    path = str(tmp_path / "rows")
    docs.repartition(8).write.json(path)
    read = spark.read.schema("doc_id long, text string, _host string").json(path)
    count = lambda d: sorted(map(str, quality_rules.apply_rules(d).collect()))
    assert count(read) == count(docs)
    other = docs.withColumnRenamed("text", "body")
    assert quality_rules.apply_rules(other, text_col="body").count() == quality_rules.apply_rules(docs).count()


def test_cascade_order_does_not_change_the_verdict(spark, docs):
    rules = quality_rules.base_rules() + quality_rules.method_rules()
    text = quality_rules.whole(docs["text"])
    one = [r[0] for r in docs.select(quality_rules.cascade(text, rules).isNull()).collect()]
    other = [r[0] for r in docs.select(quality_rules.cascade(text, rules[::-1]).isNull()).collect()]
    assert one == other
    measured = quality_rules.order_rules(docs, rules)
    rate = [share / max(seconds, 1e-6) for _, seconds, share in measured]
    assert len(measured) == len(rules) and rate == sorted(rate, reverse=True)
    kept = quality_rules.apply_rules(docs)
    assert kept.columns == docs.columns and kept.count() == sum(one)


# ------------------------------------------------------------------ BPE
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_bpe_equals_the_library(spark, docs, library):
    def want(t):
        ids = library.encode(t or "", add_special_tokens=False).ids
        return ids, library.decode(ids, skip_special_tokens=False)

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = sorted(map(key, map(tuple, bpe.encode_digests(docs, VOCABULARY).collect())))
    assert got == sorted(key((d[0], len(i), sha(" ".join(map(str, i))), sha(s))) for d in rows() for i, s in [want(d[1])])
    got = sorted(key((r.doc_id, list(r.ids), r.decoded)) for r in bpe.encode_documents(docs, VOCABULARY).collect())
    assert got == sorted(key((d[0], *want(d[1]))) for d in rows())


def test_long_words_stream_through_bounded_windows(library):
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = bpe.Encoder(bpe.Vocabulary(f.read()))
    import random
    rng = random.Random(8)
    for alphabet in ("ab", "aeiourstn", "!?-", "abcdefghijklmnopqrstuvwxyz", "é日ñ"):
        for n in (3, 30, 49, 200, 3 * encoder.window):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert encoder.ids(text) == library.encode(text, add_special_tokens=False).ids
    seen = []
    merged = encoder.merged
    encoder.merged = lambda ids: seen.append(len(ids)) or merged(ids)
    list(encoder.stream("ab" * 20_000))
    assert max(seen) <= encoder.window


def test_text_decoder_is_incremental(library):
    with open(VOCABULARY, encoding="utf-8") as f:
        vocabulary = bpe.Vocabulary(f.read())
    encoder = bpe.Encoder(vocabulary)
    ids = encoder.ids("Héllo 日本語 wörld <|endoftext|> ok")
    decoder = bpe.TextDecoder(vocabulary)
    assert "".join(decoder.feed([i]) for i in ids).split() == "héllo 日本語 wörld <|endoftext|> ok".split()
    stepwise = bpe.Decoder(vocabulary)
    assert "".join(stepwise.feed([i]) for i in ids) == library.decode(ids, skip_special_tokens=False)


# ------------------------------------------------------------------ line dedup, mixing, licences
def test_boilerplate_lines_go(spark):
    data = [(i, f"shared\nown {i}\n  shared  \n\nlast {i}", "a", "x") for i in range(6)]
    data += [(i, "copy one\ncopy two", "a", None) for i in range(10, 30)]      # one page, though copied
    data += [(40, "shared\nelsewhere", "b", None), (41, None, "a", None), (42, "shared", None, None), (43, "shared", "a", None)]
    out = line_dedup.drop_boilerplate(spark.createDataFrame(data, "doc_id int, text string, source string, _host string"), max_ratio=0.3)
    assert out.columns == ["doc_id", "text", "source", "_host"]
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "own 0\n\nlast 0" and got[10] == "copy one\ncopy two" and got[40] == "shared\nelsewhere"
    assert got[41] is None and got[42] == "shared" and got[43] == ""


def test_near_copies_are_not_boilerplate(spark):
    words = [f"w{i}" for i in range(120)]

    def copy(k):
        """Four lines of 30 words, one word of 120 changed."""
        changed = [*words[:k % 120], f"c{k}", *words[k % 120 + 1:]]
        return "\n".join(" ".join(changed[i:i + 30]) for i in range(0, 120, 30))

    article = [(i, copy(i), "a") for i in range(100)]
    own = [(1000 + i, "Home\n" + " ".join(f"p{i}x{j}" for j in range(20)) + "\nAll rights reserved by the owners of this site since long ago", "a") for i in range(200)]
    got = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(spark.createDataFrame(article + own, "doc_id int, text string, source string")).collect()}
    assert all(got[i] == text for i, text, _ in article)                      # a third of the host's pages
    assert all(got[i] == text.split("\n")[1] for i, text, _ in own)


def test_mixture_meets_its_weights(spark):
    data = [(i, "w " * 10, "big") for i in range(3000)] + [(i, "w " * 10, "small") for i in range(3000, 3100)] + [(-1, None, None)]
    docs = spark.createDataFrame(data, "doc_id int, text string, source string")
    out = mixing.mix(docs, entropy_share=0.5, max_repeats=30.0, block_tokens=500)
    got = Counter(r.source for r in out.collect())
    sizes = spark.createDataFrame([(None, 1), ("big", 30_000), ("small", 1000)], "source string, n long")
    plan = {p.source: p for p in mixing.plans(sizes, entropy_share=0.5, max_repeats=30.0).collect()}
    for source, cost in (("big", 10), ("small", 10), (None, 1)):
        p = plan[source]
        n = {"big": 3000, "small": 100, None: 1}[source]
        assert got[source] == p.epochs * n + -(-p.rest // cost)
    first = [r.block_order for r in out.filter("source = 'small' AND epoch = 0").select("block_order").distinct().orderBy("block_order").collect()]
    second = [r.block_order for r in out.filter("source = 'small' AND epoch = 1").select("block_order").distinct().orderBy("block_order").collect()]
    assert first != second


def test_exponent_limits():
    import math
    shares = [0.9, 0.06, 0.04]
    mixed = lambda a: [p ** a / sum(q ** a for q in shares) for p in shares]
    moments = lambda tried: [(sum(p ** a for p in shares), sum(p ** a * math.log(p) for p in shares)) for a in tried]
    a = mixing.exponent(moments, 3, 0.04, 1.0, 0.9, 100.0)
    assert math.isclose(-sum(w * math.log(w) for w in mixed(a)), 0.9 * math.log(3), rel_tol=1e-9)
    b = mixing.exponent(moments, 3, 0.04, 1.0, 0.9, 2.0)
    assert b > a and math.isclose(max(w / p for w, p in zip(mixed(b), shares)), 2.0, rel_tol=1e-9)


def test_many_sources_and_many_blocks(spark):
    docs = spark.range(120_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id")).alias("source"), F.lit("w w w").alias("text"))
    out = mixing.mix(docs)                                 # equal shares: every source once
    assert out.count() == 120_000 and out.select("source").distinct().count() == 120_000
    one = docs.limit(20_000).withColumn("source", F.lit("one"))
    half = mixing.mix(one, budget=0.5, block_tokens=3)     # blocks of a few documents, beyond any fixed number
    n_blocks = half.select("block_order").distinct().count()
    assert n_blocks > 3000 and half.count() == 10_000
    places = sorted(r.block_order for r in mixing.mix(one, block_tokens=3).select("block_order").distinct().collect())
    assert sorted(r.block_order for r in half.select("block_order").distinct().collect()) == places[:n_blocks]


def test_licenses_are_found_in_any_spelling(spark):
    mit = dict(license_scan.KNOWN)["MIT"]
    data = [(1, "Copyright (c) 2020 Somebody\n" + mit.replace("License", "LICENCE").replace(",", " ,\n")), (2, "text\nReleased  under the MIT licence\nmore"),
            (3, "nothing here"), (4, None), (5, ""), (6, mit + " and more")]
    got = {r.doc_id: (r.license, list(r.notices)) for r in license_scan.scan(
        spark.createDataFrame(data, "doc_id int, text string"), license_scan.known_licenses(spark)).collect()}
    assert got[1][0] == "MIT" and got[2] == (None, ["MIT-notice"])
    assert got[3] == got[4] == got[5] == (None, []) and got[6][0] is None


def test_whole_licenses_are_known(spark):
    import os
    folder = os.path.join(os.path.dirname(license_scan.__file__), "licenses")
    read = lambda name: open(os.path.join(folder, name), encoding="utf-8").read()
    mit = dict(license_scan.KNOWN)["MIT"].removeprefix("MIT License ")
    bsd = read("BSD.txt").replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("REGENTS OR", "COPYRIGHT HOLDER OR").replace("the University nor", "the copyright holder nor")
    want = {"Apache-2.0": read("Apache-2.0.txt"), "GPL-3.0": read("GPL-3.txt"), "GPL-2.0": read("GPL-2.txt"), "LGPL-2.1": read("LGPL-2.1.txt"),
            "MPL-2.0": read("MPL-2.0.txt"), "CC0-1.0": read("CC0-1.0.txt"), "BSD-3-Clause": bsd, "MIT": mit, "Unlicense": read("Unlicense.txt")}
    data = [(k, t) for k, t in want.items()] + [("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + mit), ("Apache-2.0", read("Apache-2.0.txt").split("   APPENDIX")[0])]
    out = license_scan.scan(spark.createDataFrame(data, "doc_id string, text string"), license_scan.known_licenses(spark)).collect()
    assert len(out) == len(data) and all(r.license == r.doc_id for r in out)


def test_wrapped_licenses_are_known(spark):
    import textwrap

    def wrapped(text, width):  # paragraphs anew; lines that state a copyright stay lines
        out = []
        for part in re.split(r"\n[ \t]*\n", text):
            block = []
            for line in [*part.split("\n"), None]:
                if line is None or re.match(license_scan.STATES, line.lower()):
                    out.append(textwrap.fill(" ".join(" ".join(block).split()), width, break_long_words=False, break_on_hyphens=False))
                    out.append(line or "")
                    block = []
                else:
                    block.append(line)
        return "\n".join(out)

    texts = license_scan.KNOWN + license_scan.full_texts()
    data = [(n, wrapped(t, w)) for n, t in texts for w in (40, 60, 72, 79, 100, 10_000)]
    data += [("ISC", "Copyright 2020 Someone\n\n" + wrapped(dict(texts)["ISC"], w)) for w in range(30, 120, 7)]
    isc = dict(license_scan.KNOWN)["ISC"].replace("copyright notice", "\ncopyright notice")
    data += [("ISC", isc), ("ISC", "Copyright Someone\n" + dict(license_scan.KNOWN)["ISC"])]
    out = license_scan.scan(spark.createDataFrame(data, "doc_id string, text string"), license_scan.known_licenses(spark)).collect()
    missed = Counter(r.doc_id for r in out if r.license != r.doc_id)
    assert len(out) == len(data) and not missed, missed


def test_many_known_licenses_are_joined(spark):
    known = license_scan.known_licenses(spark, [(f"L{i:04}", f"terms number {i}") for i in range(1200)])
    data = [(1, "Terms number 700"), (2, "x\nterms  number 3\nterms number 1100\nterms number 3"), (2, "x\nterms  number 3\nterms number 1100\nterms number 3"), (None, None)]
    got = sorted(map(key, ((r.doc_id, r.license, list(r.notices)) for r in license_scan.scan(spark.createDataFrame(data, "doc_id int, text string"), known).collect())))
    assert got == sorted(map(key, [(1, "L0700", ["L0700"]), *[(2, None, ["L0003", "L1100"])] * 2, (None, None, [])]))


# ------------------------------------------------------------------ personal data
def base_brute(text):
    out = []
    for kind, pattern in zip(pii.KINDS, (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
            if not (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and total % 10 == 0)
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                out.append((pii.KINDS.index(kind), *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    import random
    rng = random.Random(6)
    for _ in range(8000):
        text = "".join(rng.choice("a1.@- +()5%é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == base_brute(text), text
    for text in ("4111 1111 1111 1111", "+1 (212) 555-7777", "a@b.c@d.e@f.g", "1.2.3.4.5.6.7.8", "x" * 600 + "@b.co"):
        assert pii.base_spans(text) == base_brute(text)


def test_addresses_with_very_long_parts():
    long = "0" * 5000
    assert pii.base_spans(f"at {long}1.2.3.{long} now") == [(1, 3, 3 + 5001 + 5 + 5000)]
    assert pii.base_spans(f"{'9' * 5000}.2.3.4") == []


def test_field_adds_other_spellings_and_no_lookalikes():
    w = pii.fit(pii.made_examples(pii.MADE))
    hits, wrong, n, none = 0, 0, 0, 0
    for text, truth in pii.made_examples(600, seed=31):
        base = pii.base_spans(text)
        found = set(base) | set(pii.added_spans(text, base, w))
        assert set(base) <= found
        if truth:
            n, hits = n + 1, hits + (set(truth) <= found)
        else:
            none, wrong = none + 1, wrong + bool(found - set(base))
    assert hits >= 0.75 * n and wrong <= 0.02 * none


def segmentations(n, segments, at=0):
    """Every way to read tokens `at`..n as segments (their numbers) and single tokens."""
    if at == n:
        yield []
        return
    yield from segmentations(n, segments, at + 1)
    for k, (i, j) in enumerate(segments):
        if i == at:
            yield from ([k, *rest] for rest in segmentations(n, segments, j))


def test_dynamic_program_equals_all_segmentations():
    import itertools

    import numpy as np
    rng = np.random.default_rng(8)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        every = [(i, j) for i in range(n) for j in range(i + 1, n + 1)]
        segments = [every[k] for k in sorted(rng.permutation(len(every))[:6])]
        score = rng.normal(0, 2, (len(segments), 4))
        mass, place, best = 0.0, np.zeros_like(score), (0.0, [])
        for way in segmentations(n, segments):
            for kinds in itertools.product(range(4), repeat=len(way)):
                value = sum(score[k, c] for k, c in zip(way, kinds))
                mass += np.exp(value)
                for k, c in zip(way, kinds):
                    place[k, c] += np.exp(value)
                if value > best[0]:
                    best = (value, list(zip(way, kinds)))
        assert np.allclose(pii.forward_backward(n, segments, score), place / mass, atol=1e-12)
        assert pii.best_path(n, segments, score) == best[1]


def test_stretches_equal_the_whole_window():
    import numpy as np
    import random
    rng, w = random.Random(5), np.random.default_rng(5).normal(0, 1, (4, pii.K))
    for _ in range(300):
        text = " ".join(rng.choice(("word", "12 34 56 78", "555-1234567", "a at b dot com", "x@y", "(212) 555", ", and", "2024-01-02 11")) for _ in range(rng.randint(0, 14)))
        cut = sorted(rng.sample(range(len(text) + 1), 2)) if len(text) > 3 else None
        fixed = [(0, *cut)] if cut and rng.random() < 0.5 else []
        at, segments, x = pii.candidates(text, fixed)
        score = x @ w.T
        want = sum(score[k, kind] for k, kind in pii.best_path(len(at) - 1, segments, score))
        sure = pii.forward_backward(len(at) - 1, segments, score)
        got, spans, posterior = 0.0, [], []
        for part, pairs, values in pii.stretches(text, fixed, w):
            got += sum(values[k, kind] for k, kind in pii.best_path(len(part) - 1, pairs, values))  # values, as equal spans tie
            spans += [(part[i], part[j]) for i, j in pairs]
            posterior.append(pii.forward_backward(len(part) - 1, pairs, values))
        assert np.isclose(got, want) and spans == [(at[i], at[j]) for i, j in segments]
        assert np.allclose(np.concatenate([*posterior, np.empty((0, 4))]), sure, atol=1e-9)


def test_number_tables_in_bounded_memory():
    import tracemalloc

    import numpy as np
    text = "1234 567 89 " * 10_000
    tracemalloc.start()
    pii.added_spans(text, pii.base_spans(text), np.zeros((4, pii.K)) - 1.0)
    assert tracemalloc.get_traced_memory()[1] < 300 * len(text)  # bytes
    tracemalloc.stop()


def test_personal_data_rows(spark, docs):
    got = {}
    for r in pii.report(docs).collect():
        got.setdefault(r.doc_id, r)
    for d in rows():
        base = sorted(base_brute(d[1] or ""))
        text = pii.joined(base)
        if d[0] is not None:
            assert got[d[0]].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert set(text.split(",")) - {""} <= set(got[d[0]].spans.split(","))


# ------------------------------------------------------------------ pages
PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>
<div id="main-content"><div class="post"><h2>T &eacute; &lt;x&gt;</h2><p>One, two, three is a longer sentence.<p>Second<br>para  <a href=q>link</a>.</p>
<ul><li>item one<li>item two</ul><aside>side</aside><form><input><p>form</p></form><script>var x="</p>"</script></div>
<div class="comments"><p>nice, post, here, many, commas, and a long comment indeed for reader.</p></div></div>
<div class="cookie-notice">We use cookies</div><footer>&copy; x</footer>"""


def test_main_text():
    assert html_text.main_text(PAGE) == "T é <x>\n\nOne, two, three is a longer sentence.\n\nSecond para link.\n\nitem one\n\nitem two"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p>") == ""
    assert html_text.main_text("plain &amp; text") == "plain & text"
    assert html_text.main_text("<p>a<!-- c -->b</p><!-- cut <p>x") == "ab"
    assert html_text.main_text("<div>" * 2000 + "deep, text" + "</div>" * 2000) == "deep, text"
    assert html_text.main_text('<a href="cut>text</a><p>para, one') .endswith("para, one")


ARTICLE_PARTS = """<body><nav>menu</nav><article><h1 id="skip">T, title</h1><p id="notice">First, one.</p><section id="discussion"><p>Two, more, here.</p></section>
<section id="related-work" class="related"><h2 id="search-algorithms">Search</h2><p class="share">Three, <span id="social-life">four</span>, <span class="ad">five</span>.</p></section>
<p>Where <math><mi>x</mi></math>, <label>six</label>.</p><fieldset><legend>Seven</legend></fieldset><div id="footer-notes">Eight, nine.</div>
<div class="share">Share, this, now</div><section class="comments"><h2>Comments</h2><p>A comment, by, one.</p></section><div id="comments"><p>And, another.</p></div><div class="ad-slot"><h3>Buy</h3></div><nav>in</nav>
</article><div id="related">Other, pages</div><div class="discussion">Outside, words</div><footer>end</footer>"""


def test_article_parts_stay_whatever_their_ids():
    want = ["T, title", "First, one.", "Two, more, here.", "Search", "Three, four, five.", "Where x, six.", "Seven", "Eight, nine."]
    for page in (ARTICLE_PARTS, ARTICLE_PARTS.replace("article>", "main>")):
        assert html_text.main_text(page).split("\n\n") == want


PROSE = "<p>A first paragraph, with some words, and more of them.</p><p>A second one, which follows it, and ends.</p>"


def test_marks_that_are_part_of_a_class_or_hold_the_article_drop_nothing():
    want = "A first paragraph, with some words, and more of them.\n\nA second one, which follows it, and ends."
    for page in ('<div class="content has-sidebar">%s</div>', '<div id="page" class="no-sidebar"><article>%s</article></div>',
                 '<div class="wrap with-banner"><main>%s</main></div>', '<div class="post sponsored-free">%s</div>', '<div class="page-header-fixed">%s</div>',
                 '<article><div class="has-related entry-content">%s</div></article>', '<article><div class="related-work">%s</div></article>',
                 '<div class="banner"><article>%s</article></div>', '<div class="widget">%s</div><div class="sidebar">Other, words</div>'):
        assert html_text.main_text("<body>" + page % PROSE + "</body>") == want, page
    assert "One, two" in html_text.main_text('<article><p>A, b.</p><table class="search results"><tr><td>One, two</td></tr></table></article>')
    assert html_text.main_text(f'<body><div class="cookie-notice">We, use, cookies</div><div class="site-footer">The, end</div><div>{PROSE}</div></body>') == want


def test_nested_pages_are_read_in_linear_time():
    import time
    took = []
    for n in (2000, 16_000):
        page = "<div><p>a, b " * n
        start = time.perf_counter()
        html_text.main_text(page)
        took.append(time.perf_counter() - start)
    assert took[1] < 24 * took[0] + 0.05


def test_pages_rows(spark):
    data = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "<article><h1>A</h1><p>b", "y")]
    out = html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string, text string"))
    got = sorted(map(key, map(tuple, out.collect())))
    assert got == sorted(key((a, b, html_text.main_text(c), len(html_text.main_text(c)))) for a, b, c, _ in data)


# ------------------------------------------------------------------ classifier
def test_classifier_learns_and_keeps_labels_out(spark):
    import random
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["the", "house", "tree", "green", "of", "walks", "and", "river"]) for _ in range(40))
    bad = lambda: " ".join(rng.choice(["%%%", "$$", "BUY", "now", "!!", "xx", "click"]) for _ in range(40))
    data = [(i, good() if i % 2 else bad()) for i in range(400)] + [(1000, None), (1001, ""), (None, "the house")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1, 1), (5000, 0), (7, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality_classifier.classify(docs, labels).collect()}
    assert len(got) == len(data)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and sum(r.held_out for k, r in got.items() if k is not None and k < 400) == len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert sum(got[i].predicted == i % 2 for i in held) >= 0.95 * len(held)
    # what held-out rows are labelled makes no difference
    flipped = spark.createDataFrame([(i, 1 - i % 2 if i in held else i % 2) for i in range(400)], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in quality_classifier.classify(docs, flipped).collect()}
    assert again == {k: r.score for k, r in got.items()}


def test_clashing_labels_are_not_learnt_from(spark, monkeypatch):
    seen = []
    fit = quality_classifier.fit
    monkeypatch.setattr(quality_classifier, "fit", lambda x, y: (seen.append(y.tolist()), fit(x, y))[1])
    docs = spark.createDataFrame([(i, f"text {i % 7} of some words") for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)]
    quality_classifier.classify(docs, spark.createDataFrame(labels + [(i, 1 - i % 2) for i in range(30)] + labels[40:], "doc_id long, quality int")).collect()
    quality_classifier.classify(docs, spark.createDataFrame(labels[30:], "doc_id long, quality int")).collect()
    assert seen[0] == seen[1] and seen[0]


def test_unusable_labels_do_not_thin_the_sample(spark, monkeypatch):
    learnt = []
    fit = quality_classifier.fit
    monkeypatch.setattr(quality_classifier, "fit", lambda x, y: learnt.append(len(y)) or fit(x, y))
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(600)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(600)] * 2 + [(i, None) for i in range(600, 5000)] + [(i, 1) for i in range(5000, 9000)]
    quality_classifier.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"), max_labelled=100)
    assert learnt == [100]


# ------------------------------------------------------------------ all of them
def test_awkward_and_empty_tables(spark, docs, empty):
    n = len(rows())
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for run in (lambda d: quality_classifier.classify(d, labels), lambda d: line_dedup.line_report(d), lambda d: pii.report(d),
                lambda d: license_scan.license_report(spark, d), quality_rules.quality_rules, lambda d: bpe.encode_digests(d, VOCABULARY)):
        assert len(run(docs).collect()) == n
        assert run(empty).collect() == []
    assert mixing.mix(empty).collect() == [] and line_dedup.drop_boilerplate(empty).collect() == [] and quality_rules.apply_rules(empty).collect() == []
    assert mixing.mix(docs.drop("epoch")).drop("block_order", "epoch").columns == docs.drop("epoch").columns
    assert line_dedup.drop_boilerplate(docs).columns == docs.columns == [c.split(" ")[0] for c in SCHEMA.split(", ")]
