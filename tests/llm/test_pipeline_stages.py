"""The pipeline's stages, each on what the one before it kept."""

import hashlib
import tracemalloc
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_search import shingles
from tokenizers import Tokenizer

import corpus_pipeline
from callfunnel.llm import line_dedup, mixing, quality_rules
from callfunnel.llm.common import stored

SF = "/root/testdata/sf0.001"


def line_key(line):
    trimmed = line_dedup.bare(line)
    return F.when(trimmed != "", F.xxhash64(trimmed))


@pytest.fixture(scope="module")
def steps(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "step"))
    return out


def test_stages_return_the_columns_of_documents(spark, steps):
    want = steps[0].dtypes
    assert all(s.dtypes == want for s in steps[:-1])


def test_rules_then_lines(steps):
    verdict = {r.doc_id: r.kept for r in quality_rules.quality_rules(steps[0]).collect()}
    assert sorted(r.doc_id for r in steps[1].collect()) == sorted(i for i, kept in verdict.items() if kept)
    known = {r.host: set(r.lines) for r in line_dedup.boilerplate(steps[1], "source", "text", 0.01, 5).collect()}
    before, after = ({r.doc_id: r for r in s.withColumn("keys", F.transform(F.split("text", "\n"), line_key)).collect()} for s in steps[1:3])
    assert before.keys() == after.keys()
    for i, row in before.items():
        assert after[i]["keys"] == ([k for k in row["keys"] if k not in known.get(row.source, ())] or [None])
        assert after[i].n_chars == len(after[i].text)


def test_one_of_each_class_stays(steps):
    docs = {r.doc_id: shingles(r.text, 5) for r in steps[2].collect()}
    kept = {r.doc_id for r in steps[3].collect()}
    near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    assert not any(near(docs[i], docs[j]) for i in kept for j in kept if i < j)
    assert all(i in kept or any(near(s, docs[j]) for j in docs if j < i) for i, s in docs.items())


def test_mixture_and_tokens(spark, steps):
    want = Counter(r.doc_id for r in mixing.mix(steps[3]).collect())
    assert Counter(r.doc_id for r in steps[4].collect()) == want
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    for r in steps[5].collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert Counter(r.doc_id for r in steps[5].collect()) == want


def test_run_equals_its_stages(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[5].collect()))


def test_texts_that_cannot_go_are_not_dealt_out(spark):
    from callfunnel.llm import near_dup
    keys = spark.range(0, 4000, 40).selectExpr("id AS k")
    rows = spark.range(4000).selectExpr("nullif(id, 3999) AS id", "repeat(chr(97 + CAST(id % 26 AS INT)), 5) AS text")
    may, stay = near_dup.key_filter(keys, "k")(rows, "id")
    assert may.columns == stay.columns == rows.columns
    assert may.count() + stay.count() == 4000
    assert may.join(keys, may.id == keys.k, "left_semi").count() == 100  # every key is let through
    assert may.count() < 1000  # and few others are
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{words} {i % 3}" if i < 9 else f"other words of text number {i} only") for i in range(30)] + [(None, words)], "doc_id long, text string")
    kept = near_dup.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, *range(9, 30)]
    assert "_bits" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_texts_move_in_small_batches(spark):
    from callfunnel.llm import common, near_dup

    def sizes(batches):
        for b in batches:
            yield b.select(["n"]).slice(0, 0) if not b.num_rows else type(b).from_pydict({"n": [b.num_rows]})

    before = {k: spark.conf.get(k) for k in common.BATCHES}
    found = stored(spark.range(0, 3000, 1, 1).selectExpr("id AS n").mapInArrow(sizes, "n long"), "sizes", common.TEXT_ROWS)
    got = [r.n for r in found.collect()]
    assert sum(got) == 3000 and max(got) <= common.TEXT_ROWS
    with pytest.raises(ValueError), common.small_batches(spark, 5):
        assert {spark.conf.get(k) for k in common.BATCHES} == {"5"}
        raise ValueError
    assert {k: spark.conf.get(k) for k in common.BATCHES} == before

    known = near_dup._Hashes()
    tracemalloc.start()
    try:
        for at in range(0, 200_000, 1000):
            near_dup.shingle_set(" ".join(f"word{i}" for i in range(at, at + 1000)), known)
        assert tracemalloc.get_traced_memory()[0] < 16 << 20
    finally:
        tracemalloc.stop()
