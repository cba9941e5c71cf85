"""Quality classifier: random-indexing word vectors pooled per document, then a small calibrated network.

Random indexing: every word has a fixed sparse ternary index vector; a word's vector is the sum of
the index vectors of its neighbours over the whole corpus. Words are hashed into BUCKETS rows, so
the table has a size that doesn't depend on the corpus. A document is the mean and spread of its
words' vectors and the self-similarity of its index vectors at small distances. A two-layer numpy
network is fitted on a bounded sample of labelled rows; a temperature fitted on rows that the
network has not seen calibrates its probabilities.

Only the text is an input of a score. Null and empty texts are scored as texts without words.
Rows with null or repeated ids are scored like any other; labels that are null, or whose id has
no document, are not learnt from. With no usable labels, or one class only, every score is the
share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import drop_stored, stored, whole

BUCKETS, DIM, NONZERO, SPAN, LAGS = 1 << 14, 32, 4, 2, 8
KNOWN_WORDS = 300_000  # memory bound of the word-bucket memo; it is emptied when full
BLOCK = 1 << 16  # words pooled at a time
TOKEN = re.compile(r"\w+|[^\w\s]")


def index_vectors() -> np.ndarray:
    """Row per bucket: NONZERO entries of +1 or -1 among DIM, the same everywhere."""
    rng = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIM), np.int8)
    at = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO)), axis=1)
    return out


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        b = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        return b


def bucket_ids(text: str | None, known: dict) -> np.ndarray:
    tokens = TOKEN.findall(text) if text else []
    return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))


def add_contexts(total: np.ndarray, counts: np.ndarray, docs: list[np.ndarray], index: np.ndarray) -> None:
    """Add to `total` the index vectors of every word's neighbours within SPAN, documents apart."""
    gap = np.full(SPAN, -1, np.int32)
    ids = np.concatenate([x for d in docs for x in (d, gap)]) if docs else gap
    for at in range(0, len(ids), BLOCK):
        part = ids[max(0, at - SPAN):at + BLOCK + SPAN]
        lead = at - max(0, at - SPAN)
        mine = part[lead:lead + min(BLOCK, len(ids) - at)]
        vectors = np.where(part[:, None] >= 0, index[part], np.int8(0))
        padded = np.vstack([np.zeros((SPAN, DIM), np.int8), vectors, np.zeros((SPAN, DIM), np.int8)])
        around = sum(padded[SPAN + lead + k:SPAN + lead + k + len(mine)].astype(np.int16) for k in range(-SPAN, SPAN + 1) if k)
        order = np.argsort(mine, kind="stable")
        word, start = np.unique(mine[order], return_index=True)
        sums = np.add.reduceat(around[order].astype(np.int32), start, axis=0)
        real = word >= 0
        total[word[real]] += sums[real]
        counts[word[real]] += np.diff(np.append(start, len(mine)))[real]


def context_table(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(BUCKETS x DIM context sums, BUCKETS counts) over every text; a bounded number of rows reaches the driver."""
    names = [f"v{i}" for i in range(DIM)]

    def run(batches):
        index, known = index_vectors(), _Buckets()
        total, counts = np.zeros((BUCKETS, DIM), np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(at, 256).to_pylist()
                add_contexts(total, counts, [bucket_ids(t, known) for t in texts if t], index)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen]), *(pa.array(np.ascontiguousarray(total[seen, i])) for i in range(DIM))],
                                         ["bucket", "n", *names])

    partial = docs.select(docs[text_col].alias("text")).mapInArrow(run, "bucket int, n long, " + ", ".join(f"{c} long" for c in names))
    rows = partial.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).toArrow()
    table, counts = np.zeros((BUCKETS, DIM)), np.zeros(BUCKETS)
    bucket = rows["bucket"].to_numpy()
    counts[bucket] = rows["n"].to_numpy()
    table[bucket] = np.column_stack([rows[c].to_numpy() for c in names]) if len(bucket) else 0
    return table, counts


def word_vectors(table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Unit word vectors (+ one column: how common the bucket is), as float32."""
    centred = table - counts[:, None] * (table.sum(axis=0) / max(counts.sum(), 1))
    norm = np.linalg.norm(centred, axis=1, keepdims=True)
    share = np.log1p(counts) / max(np.log1p(counts).max(initial=0), 1e-9)
    return np.hstack([centred / np.maximum(norm, 1e-9), share[:, None]]).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """A document's features; blocks keep memory bounded for very long texts."""
    n, width = len(ids), vectors.shape[1]
    out = np.zeros(2 * width + DIM + LAGS + 2, np.float32)
    if not n:
        return out
    first, second, raw, alike = np.zeros(width), np.zeros(width), np.zeros(DIM), np.zeros(LAGS)
    for at in range(0, n, BLOCK):
        part = ids[at:at + BLOCK + LAGS]
        own = vectors[part[:BLOCK]]
        first += own.sum(axis=0)
        second += (own * own).sum(axis=0)
        signs = index[part].astype(np.float32)
        raw += signs[:BLOCK].sum(axis=0)
        for lag in range(1, min(LAGS, len(part) - 1) + 1):
            m = min(BLOCK, len(part) - lag)
            alike[lag - 1] += np.einsum("ij,ij->", signs[:m], signs[lag:lag + m])
    mean = first / n
    out[:width] = mean
    out[width:2 * width] = np.sqrt(np.maximum(second / n - mean * mean, 0))
    out[2 * width:2 * width + DIM] = np.abs(raw) / n
    out[2 * width + DIM:-2] = alike / (NONZERO * n)
    out[-2:] = np.log1p(n) / 10, np.linalg.norm(raw) / n
    return out


FEATURES = 2 * (DIM + 1) + DIM + LAGS + 2


@dataclass
class Network:
    """Two layers: ReLU, then one logit; `temperature` divides the logit."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.shift) / self.scale, -8, 8)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 48, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4,
        seed: int = 11) -> Network:
    """Adam on cross-entropy over four fifths of the rows; the temperature over the rest."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 10 or share in (0.0, 1.0):
        zero = np.zeros
        return Network(zero(FEATURES), np.ones(FEATURES), zero((FEATURES, 1)), zero(1), zero(1), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held, used = order[:len(y) // 5], order[len(y) // 5:]
    shift, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
    p = {"w1": rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), "b1": np.zeros(hidden),
         "w2": rng.normal(0, np.sqrt(1 / hidden), hidden), "b2": np.array(np.log(share / (1 - share)))}
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    z, target = np.clip((x - shift) / scale, -8, 8), y.astype(float)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            h = np.maximum(z[rows] @ p["w1"] + p["b1"], 0)
            error = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - target[rows]) / len(rows)
            back = np.outer(error, p["w2"]) * (h > 0)
            g = {"w1": z[rows].T @ back + decay * p["w1"], "b1": back.sum(axis=0), "w2": h.T @ error + decay * p["w2"], "b2": error.sum()}
            t += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    net = Network(shift, scale, p["w1"], p["b1"], p["w2"], float(p["b2"]))
    logit, truth = net.logits(x[held]), target[held]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
    loss = [np.mean(np.logaddexp(0, logit / c) - truth * logit / c) for c in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _map(docs: DataFrame, id_col: str, text_col: str, vectors, make, column: str) -> DataFrame:
    def run(batches):
        index, known = index_vectors(), _Buckets()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = np.array([pooled(bucket_ids(t, known), vectors.value, index) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), make(x)], ["doc_id", column.split(" ")[0]])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("doc_id"), whole(docs[text_col]).alias("text")).mapInArrow(run, f"doc_id {kind}, {column}")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             max_labelled: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    At most `max_labelled` labelled rows, chosen by a hash of their id, are learnt from, never rows
    that `held_out` marks. An id that is labelled both ways is not learnt from. The context table covers every text.
    """
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(word_vectors(*context_table(docs, text_col)))
    known = (labels.select(labels[id_col].alias("label_id"), labels[label_col].cast("int").alias("label"))
             .filter("label_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("label_id")))
             .groupBy("label_id").agg(F.min("label").alias("label"), F.max("label").alias("_high")).filter("label = _high").drop("_high"))
    known = usable = stored(known.join(docs.select(docs[id_col].alias("doc_id")), F.col("label_id") == F.col("doc_id"), "left_semi"), "labels")
    share = (max_labelled + 8 * max_labelled ** 0.5 + 50) / max(usable.count(), 1)  # the lowest hashes; too few with probability under 1e-14
    if share < 1:
        known = known.filter(F.xxhash64("label_id") < F.lit(int(share * 2 ** 64) - 2 ** 63))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled)
    wanted = known.select("label_id")
    some = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).join(wanted, F.col("doc_id") == F.col("label_id"), "left_semi")
    learnt = _map(some, "doc_id", "text", vectors, lambda x: pa.array(list(x), pa.list_(pa.float32())), "features array<float>")
    rows = learnt.join(known, learnt["doc_id"] == known["label_id"]).select("doc_id", "features", "label").orderBy("doc_id", "features").limit(max_labelled).toArrow()
    drop_stored(spark, usable)
    x = np.array(rows["features"].to_pylist(), np.float64).reshape(-1, FEATURES)
    net = spark.sparkContext.broadcast(fit(x, rows["label"].to_numpy().astype(int)))
    scored = _map(docs, id_col, text_col, vectors, lambda x: pa.array(net.value.scores(x.astype(np.float64))), "score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
