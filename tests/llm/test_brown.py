"""Language-model scores against plain dictionaries and loops."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from data import rows, table

from callfunnel.llm import brown
from callfunnel.llm.common import stored


def tokens(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w] + [None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def corpus():
    """Sentences from a small grammar, so that words have classes; and the awkward rows."""
    rng = random.Random(5)
    kinds = [[f"{k}{i}" for i in range(40)] for k in ("adj", "noun", "verb", "Adv")]
    out = [(i, " ".join(rng.choice(kinds[k % 4]) for k in range(rng.randint(4, 80)))) for i in range(400)]
    return out + [(1000 + k, t) for k, (_, t, *_) in enumerate(rows())] + [(None, "null ids are learnt from"), (3, "twice"), (3, "twice")]


def class_of(model, word):
    return len(model.words) - 1 if word is None else int(model.table[xxhash.xxh3_64_intdigest(word.encode()) >> 44])


@pytest.fixture(scope="module")
def fitted(spark):
    data = corpus()
    blocks = stored(brown.token_blocks(spark.createDataFrame(data, "doc_id long, text string").repartition(3), "doc_id", "text", 10), "blocks")
    return data, blocks, brown.fit(blocks, stored(brown.counted(blocks), "counts"), classes=6, sweeps=3)


def test_counts_and_classes(spark, fitted):
    data, blocks, model = fitted
    train = [tokens(t) for d, t in data if not held(d)]
    count = Counter(w for ws in train for w in ws)
    got, parts = {}, defaultdict(list)
    for r in brown.counted(blocks).filter("block IS NOT NULL").collect():
        parts[r.block].append((r.range, r.counts))
    for r in blocks.collect():
        words = np.sort(np.frombuffer(r.words, np.uint64)).tolist()
        got.update(zip(words, np.concatenate([brown.unplanes(c) for _, c in sorted(parts[r.block])]).tolist()))
    key = lambda w: xxhash.xxh3_64_intdigest(b" " if w is None else w.encode())
    assert {k: c for k, c in got.items() if c} == {key(w): c for w, c in count.items()}
    assert len(got) == len({w for _, t in data for w in tokens(t)})
    assert (model.n_tokens, model.n_words) == (sum(count.values()), len(count))
    pairs = Counter((class_of(model, a), class_of(model, b)) for ws in train for a, b in zip([None, *ws], ws))
    assert model.bigrams.tolist() == [[pairs[a, b] for b in range(7)] for a in range(7)]
    assert model.words.tolist() == [sum(class_of(model, w) == c for w in count) for c in range(7)]


def test_exchange_finds_the_grammar(spark, fitted):
    data, blocks, model = fitted
    train = [tokens(t) for d, t in data if not held(d)]
    first = np.random.default_rng(17).integers(0, 6, brown.BUCKETS)
    pairs = Counter()
    for ws in train:
        cs = [6 if w is None else int(first[xxhash.xxh3_64_intdigest(w.encode()) >> 44]) for w in ws]
        pairs.update(zip([6, *cs], cs))
    start = np.array([[pairs[a, b] for b in range(7)] for a in range(7)])
    assert brown.likelihood(model.bigrams) > brown.likelihood(start)
    by_kind = defaultdict(Counter)
    for ws in train[:300]:
        for w in ws:
            if w and w[:3] in ("adj", "nou", "ver", "adv") and w[-1].isdigit():
                by_kind[w[:3]][class_of(model, w)] += 1
    assert all(c.most_common(1)[0][1] >= 0.5 * sum(c.values()) for c in by_kind.values())


def test_best_class_is_the_best_move():
    """A move of one small line raises the likelihood as much as any other would, whole tables compared."""
    rng = np.random.default_rng(2)
    bigrams = rng.integers(200, 5000, (5, 5))
    for _ in range(30):
        line = rng.integers(0, 4, 10) * (rng.random(10) < 0.6)
        line[5:] = rng.permutation(np.bincount(rng.integers(0, 5, line[:5].sum()), minlength=5)) if line[:5].sum() else 0
        own = int(rng.integers(0, 4))
        value = []
        for c in range(4):
            m = bigrams.copy()
            m[own] -= line[:5]
            m[:, own] -= line[5:]
            m[c] += line[:5]
            m[:, c] += line[5:]
            value.append(brown.likelihood(m))
        got = int(brown.best_classes(line[None].astype(np.int64), np.array([own]), bigrams)[0])
        assert value[got] >= max(value) - 0.05


def test_scores_equal_plain_loops(spark, fitted):
    data, _, model = fitted
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = brown.scores(docs, classes=6, sweeps=3).collect()
    count = Counter(w for d, t in data if not held(d) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    log_t = model.log_transitions()
    assert np.allclose((10 ** log_t).sum(axis=1), 1)
    size, want = model.bigrams.sum(axis=0), []
    for d, t in data:
        ws = tokens(t)
        cs = [class_of(model, w) for w in ws]
        emit = [0.0 if w is None else math.log10((count[w] + 0.1) / (size[c] + 0.1 * (model.words[c] + 1))) for w, c in zip(ws, cs)]
        want.append((d, held(d), len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws),
                     sum(emit) + sum(log_t[a, b] for a, b in zip([6, *cs], cs))))
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(got) == len(want)
    for g, w in zip(sorted((tuple(r) for r in got), key=order), sorted(want, key=order)):
        assert g[:5] == w[:5] and g[5:7] == pytest.approx(w[5:7], rel=1e-9) and g[7] == pytest.approx(10 ** min(300, -w[6] / w[2]), rel=1e-6)
    out = [r for r in got if r.held_out]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_emissions_of_a_class_add_up(fitted):
    data, _, model = fitted
    count = Counter(w for d, t in data if not held(d) for w in tokens(t) if w)
    total = np.zeros(6)
    for w, c in count.items():
        total[class_of(model, w)] += 10 ** model.log_emissions(np.array([class_of(model, w)]), np.array([c]))[0]
    unknown = 10 ** model.log_emissions(np.arange(6), np.zeros(6, int))
    assert np.allclose(total + unknown, 1)


def test_blocks_are_cut_and_merged(spark, fitted, monkeypatch):
    """Many small blocks, texts in chunks, and the two-level sums give the same classes."""
    data, blocks, model = fitted
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 1)
    monkeypatch.setattr(brown, "CHUNK", 50)
    monkeypatch.setattr(brown, "RANGE_WORDS", 500)
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    small = stored(brown.token_blocks(docs, "doc_id", "text", 10), "blocks")
    assert small.count() > 256
    again = brown.fit(small, stored(brown.counted(small), "counts"), classes=6, sweeps=3)
    assert np.array_equal(again.table, model.table) and np.array_equal(again.bigrams, model.bigrams)


def test_awkward_and_empty_tables(spark):
    got = brown.scores(table(spark), classes=4, sweeps=1)
    assert got.count() == len(rows())
    empty = {r.n_tokens for r in got.collect() if r.doc_id in (9, 10, 11)}
    assert empty == {1}
    assert brown.scores(table(spark, [])).collect() == []
    only_held = next(i for i in range(100) if held(i))
    row = brown.scores(table(spark, [(only_held, "a b", *[None] * 7)])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
