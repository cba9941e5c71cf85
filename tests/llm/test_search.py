"""Near duplicates and nearest neighbours against brute force."""

import math
import random

import numpy as np
import pytest
from data import prose, rows, table

from callfunnel.llm import ann, near_dup


def shingles(text, size):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    return frozenset(zip(*(ws[i:] for i in range(size)))) if len(ws) >= size else frozenset([tuple(ws)] if ws else [])


def brute(data, size):
    """(n_shingles, component_id, kept) of every row."""
    sets = [shingles(t, size) for _, t in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(data):
        ids = [data[j][0] for j in range(len(data)) if find(j) == find(i) and data[j][0] is not None]
        component = (min(ids) if ids else None) if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc == component))
    return out


def corpus():
    """Groups of near copies (chains and stars), copies, and texts that share a passage without being near."""
    rng = random.Random(12)
    out, passage = [r[:2] for r in rows()], prose(rng, 60)
    for _ in range(6):
        words = prose(rng, rng.randint(15, 150)).split()
        for _ in range(rng.randint(1, 25)):
            if rng.random() < 0.5:
                words = list(words)
                words[rng.randrange(len(words))] = "edit"
            out.append((1000 + len(out), " ".join(words)))
    out += [(1000 + len(out) + i, passage + " " + prose(rng, 40)) for i in range(30)]
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    data = corpus()
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(repr(tuple(r)) for r in near_dup.near_duplicates(docs, shingle=size).collect())
    assert got == sorted(map(repr, brute(data, size)))


def test_near_duplicates_keep_one(spark):
    out = near_dup.keep_one(table(spark))
    assert out.columns == table(spark).columns
    data = [r[:2] for r in rows()]
    want = {d for d, _, _, kept in brute(data, 5) if kept and d is not None}
    got = [r.doc_id for r in out.collect() if r.doc_id is not None]
    assert sorted(got) == sorted(want)
    assert near_dup.near_duplicates(table(spark, [])).collect() == []
    assert near_dup.keep_one(table(spark, [])).collect() == []


def test_texts_that_share_an_id_go_by_themselves(spark):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join(reversed(words))
    data = [(3, a), (5, b), (5, a), (7, "x " + " ".join(words[::2])), (7, "x " + " ".join(words[::2]) + " end"), (None, a)]
    got = [(r.doc_id, r.text) for r in near_dup.keep_one(spark.createDataFrame(data, "doc_id long, text string")).collect()]
    sevens = [r for r in got if r[0] == 7]
    assert len(sevens) == 1 and sevens[0] in data
    assert sorted(map(repr, (r for r in got if r[0] != 7))) == sorted(map(repr, [(3, a), (5, b), (None, a)]))


def test_components_are_the_smallest_reachable(spark):
    rng = random.Random(1)
    pairs = [(f"{i:04d}", f"{i + 1:04d}") for i in range(300) if i % 50] + [("hub", f"x{i}") for i in range(200)]
    rng.shuffle(pairs)
    got = {r.node: r.component for r in near_dup.connected(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert all(got[f"{i:04d}"] == f"{max(1, (i - 1) // 50 * 50 + 1):04d}" for i in range(1, 300))
    assert {got[f"x{i}"] for i in range(200)} == {"hub"} == {got["hub"]}


VECTORS = "vec_id long, embedding array<float>, label int, v string, name string"


def vectors():
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(30, 12)) * 3
    data = [(i, [float(x) for x in (middle[i % 30] + rng.normal(size=12)).astype(np.float32)], 0, "v", "n") for i in range(2500)]
    data += [(3000 + i, data[0][1], 0, None, None) for i in range(200)]            # one vector many times
    data += [(5000, None, 0, "", ""), (5100, [0.0] * 12, 0, "", ""), (5200, [float("nan")] * 12, 0, "", ""), (5300, [None] * 12, 0, "", ""),
             (5400, [float("inf")] * 12, 0, "", ""), (5500, [1.0], 0, "", ""), (None, data[1][1], 0, "", ""), data[5]]
    return data


def test_nearest_neighbours(spark):
    data = vectors()
    got = {}
    for r in ann.search(spark.createDataFrame(data, VECTORS), lambda i: i % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    ok = {i: np.array(v, float) for i, v, *_ in data if i is not None and v and len(v) == 12 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids, x = np.array(list(ok)), np.array(list(ok.values()))
    assert sorted(got) == sorted(i for i in ok if i % 100 == 0)
    hit = n = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        d = np.sqrt(((x - ok[q]) ** 2).sum(axis=1))
        order = [int(ids[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:10]
        hit, n = hit + len({f[1] for f in found} & set(order)), n + 10
        assert all(abs(f[2] - np.sqrt(((ok[f[1]] - ok[q]) ** 2).sum())) < 1e-12 for f in found)
        assert [f[1:] for f in found] == sorted((f[1:] for f in found), key=lambda f: (f[1], f[0]))
    assert hit >= 0.9 * n
    same = [f[1] for f in sorted(got[3000])]
    assert same == [0, *range(3001, 3010)]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, "", ""), (1, [0.0, 1.0], 0, "", ""), (2, [1.0, 1.0], 0, "", "")], VECTORS)
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.search(few, lambda i: i % 100 == 0).orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]
    assert ann.search(few.limit(0), lambda i: i % 100 == 0).collect() == []
