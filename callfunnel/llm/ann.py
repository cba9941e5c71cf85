"""Approximate nearest neighbours with a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and every vector is filed under a leaf. A query walks the
tree with a priority queue of centre distances and gets the leaves in the order it would open
them. How many leaves are opened is calibrated: for some queries the true neighbours are found by
brute force over all vectors, and visits are widened until the target share of them is covered.
A query's first leaves bound its distance; the others give out nothing beyond that bound, so what is
given out per query doesn't grow with the number of leaves.

Equal vectors are one entry with its k + 1 smallest ids, which is exact (ties go to smaller ids)
and keeps a vector that fills a third of the table from filling a group. Leaves are cut into
blocks of bounded size on both sides of the search.

Vectors that are null, zero, of another length than most, or hold a null or non-finite component
take no part; neither do rows with a null id. Rows that repeat id and vector count once. Extra
columns are not read. An empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callfunnel.llm.common import drop_stored, stored

SAMPLE_ROWS = 16_384  # bound of the sample that the tree is fitted on
CALIBRATION_QUERIES = 256  # bound of the queries whose true neighbours are found by brute force
LEAF_ROWS = 256  # vectors aimed at in a leaf, as far as the sample allows
BRANCHES = 16
BLOCK_ROWS = 4096
FIRST = 8  # leaves that bound a query's distances before the others are opened
TARGET = 0.985


@dataclass
class Tree:
    """centres[i] is node i's centre, children[i] its nodes (empty: a leaf), leaf[i] its number or -1."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    @property
    def n_leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row: the nearest child, from the root down."""
        at = np.zeros(len(x), np.int64)
        moving = np.arange(len(x)) if self.children[0] else np.empty(0, np.int64)
        while len(moving):
            for node in np.unique(at[moving]):
                rows = moving[at[moving] == node]
                kids = self.children[node]
                at[rows] = np.array(kids)[distances(x[rows], self.centres[kids]).argmin(axis=1)]
            moving = moving[[bool(self.children[n]) for n in at[moving]]]
        return self.leaf[at]

    def order(self, query: np.ndarray, most: int) -> list[int]:
        """The first `most` leaves, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(int(self.leaf[node]))
                continue
            for d, kid in zip(distances(query[None], self.centres[kids])[0], kids):
                heapq.heappush(queue, (float(d), kid))
        return out


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows of x by centres; for choosing, not for scores."""
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = distances(x, centres).argmin(axis=1)
        used = np.unique(near)
        centres = np.array([x[near == c].mean(axis=0) for c in used])
    return centres, distances(x, centres).argmin(axis=1)


def build(sample: np.ndarray, rows: int, seed: int = 5) -> Tree:
    """A tree over the sample, whose leaves would hold about LEAF_ROWS of `rows` vectors."""
    rng = np.random.default_rng(seed)
    small = max(4, LEAF_ROWS * len(sample) // max(rows, 1))
    centres, children, todo = [sample.mean(axis=0)], [[]], [(0, sample)]
    while todo:
        node, x = todo.pop()
        if len(x) <= small:
            continue
        found, near = kmeans(x, min(BRANCHES, -(-len(x) // small)), rng)
        if len(found) < 2 or len(np.unique(near)) < 2:
            continue
        for c in np.unique(near):
            children[node].append(len(centres))
            todo.append((len(centres), x[near == c]))
            centres.append(found[c])
            children.append([])
    is_leaf = np.array([not c for c in children])
    return Tree(np.array(centres), children, np.where(is_leaf, np.cumsum(is_leaf) - 1, -1))


def exact(query: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision."""
    gap = x - query
    return np.sqrt((gap * gap).sum(axis=1))


def nearest(query: np.ndarray, x: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the k nearest rows, ties to the smaller first id."""
    d = exact(query, x)
    at = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
    at = at[np.lexsort((first[at], d[at]))][:k]
    return at, d[at]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    v = F.col("v")
    out = (vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
           .filter(F.col("vec_id").isNotNull() & v.isNotNull())
           .filter(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)))
    lengths = out.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), "n").first()
    return out.filter(F.size("v") == (most["n"] if most else 0)).withColumn("v", F.transform("v", lambda x: x + 0.0))


def matrix(column) -> np.ndarray:
    return np.array(column.to_pylist() if hasattr(column, "to_pylist") else list(column), np.float64)


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
           target: float = TARGET) -> DataFrame:
    """Per query row: query_id, rank, vec_id, score of its k nearest; `is_query` is a condition on vec_id."""
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vector_col).distinct(), "vectors")
    # entries: distinct vectors, each with its k + 1 smallest ids and its smallest id as its name
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ids = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    entries = stored(ids.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("name", F.col("ids")[0]), "entries")
    n = entries.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.select("v") if n <= SAMPLE_ROWS else entries.select("v").sample(SAMPLE_ROWS / n * 0.9, seed=3).limit(SAMPLE_ROWS)
    points = matrix(sample.toArrow()["v"])
    tree = build(points if len(points) else np.zeros((1, 1)), n)
    shared = spark.sparkContext.broadcast(tree)

    def file(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                leaf = shared.value.file(matrix(part.column(0)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaf.astype(np.int32))], ["v", "ids", "name", "leaf"])

    index = stored(entries.mapInArrow(file, "v array<double>, ids array<long>, name long, leaf int"), "index")
    queries = rows.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "v")
    asked = stored(index.join(queries.select("v").distinct(), "v", "left_semi").select("name", "v", "leaf"), "asked")
    visits = calibrated(index, asked, tree, k, target)

    def order(batches):
        for batch in batches:
            leaves = [shared.value.order(q, visits) for q in matrix(batch.column(1))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaves, pa.list_(pa.int32()))], ["name", "v", "leaves"])

    walks = asked.select("name", "v").mapInArrow(order, "name long, v array<double>, leaves array<int>")
    walks = stored(walks.select("name", "v", F.posexplode("leaves").alias("place", "leaf")), "walks")
    # the first leaves give each query its bound, the others only what lies within it
    first = stored(nearest_of(visited(index, walks.filter(F.col("place") < FIRST).withColumn("bound", F.lit(float("inf"))), k), k), "first")
    bounds = first.groupBy("name").agg(F.when(F.count("*") > k, F.max("score")).otherwise(float("inf")).alias("bound"))
    rest = walks.filter(F.col("place") >= FIRST).join(bounds, "name")
    found = stored(nearest_of(first.unionByName(visited(index, rest, k)), k), "found")
    # entries back to ids, entries' queries back to rows
    named = index.select(F.col("name").alias("entry"), "ids")
    listed = found.join(named, "entry").select("name", "score", F.explode("ids").alias("vec_id"))
    best = F.row_number().over(Window.partitionBy("name").orderBy("score", "vec_id"))
    listed = stored(listed.withColumn("n", best).filter(F.col("n") <= k + 1).drop("n"), "listed")
    of_row = queries.join(asked.select("name", "v"), "v").select("query_id", "name").distinct()
    out = of_row.join(listed, "name").filter("query_id <> vec_id")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    out = out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    out = stored(out.withColumn("rank", best).filter(F.col("rank") <= k)
                 .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "nearest")
    drop_stored(spark, rows, entries, index, asked, walks, first, found, listed)
    return out


def nearest_of(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest entries of each query's found ones."""
    best = F.row_number().over(Window.partitionBy("name").orderBy("score", "entry"))
    return found.withColumn("n", best).filter(F.col("n") <= k + 1).drop("n")


def visited(index: DataFrame, walks: DataFrame, k: int) -> DataFrame:
    """(name, entry, score): of each leaf that a query (name, v, leaf, bound) visits the k + 1 nearest entries within the bound."""
    sizes = index.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("i_blocks"))
    asks = walks.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("q_blocks"))
    blocks = sizes.join(asks, "leaf")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (walks.join(blocks, "leaf").withColumn("q", F.pmod(F.xxhash64("name"), "q_blocks").cast("int"))
            .select("leaf", "q", every("i_blocks").alias("i"), "name", "v", "bound"))
    right = (index.join(blocks, "leaf").withColumn("i", F.pmod(F.xxhash64("name"), "i_blocks").cast("int"))
             .select("leaf", every("q_blocks").alias("q"), "i", F.col("name").alias("entry"), "v"))

    def compare(_, asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        names, entry, score = [], [np.empty(0, np.int64)], [np.empty(0)]
        if len(asking) and len(held):
            x, first = matrix(held["v"]), held["entry"].to_numpy()
            for name, v, bound in zip(asking["name"], asking["v"], asking["bound"]):
                at, d = nearest(np.asarray(v, np.float64), x, first, k + 1)
                at, d = at[d <= bound], d[d <= bound]
                names += [name] * len(at)
                entry.append(first[at])
                score.append(d)
        return pd.DataFrame({"name": np.array(names, np.int64), "entry": np.concatenate(entry), "score": np.concatenate(score)})

    keys = ["leaf", "q", "i"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "name long, entry long, score double")


def brute_force(index: DataFrame, names: np.ndarray, x: np.ndarray, k: int) -> DataFrame:
    """(name, leaf, score): the k nearest entries of a bounded set of queries, over all entries in blocks."""
    asked = index.sparkSession.sparkContext.broadcast((names, x))

    def run(batches):
        names, x = asked.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                own, first, leaf = matrix(part.column(0)), part.column(1).to_numpy(), part.column(2).to_numpy()
                got = [(name, *nearest(q, own, first, k)) for name, q in zip(names, x)]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, [len(g[1]) for g in got])),
                                                  pa.array(np.concatenate([first[g[1]] for g in got])),
                                                  pa.array(np.concatenate([leaf[g[1]] for g in got])),
                                                  pa.array(np.concatenate([g[2] for g in got]))], ["name", "entry", "leaf", "score"])

    rows = index.select("v", "name", "leaf").mapInArrow(run, "name long, entry long, leaf int, score double")
    place = F.row_number().over(Window.partitionBy("name").orderBy("score", "entry"))
    return rows.withColumn("n", place).filter(F.col("n") <= k)


def calibrated(index: DataFrame, asked: DataFrame, tree: Tree, k: int, target: float) -> int:
    """The fewest leaves to open so that `target` of the sampled queries' true neighbours are in them."""
    some = asked.orderBy(F.xxhash64("name"), "name").limit(CALIBRATION_QUERIES).toArrow()
    if not some.num_rows or tree.n_leaves < 2:
        return max(1, tree.n_leaves)
    names, x = some["name"].to_numpy(), matrix(some["v"])
    truth = brute_force(index, names, x, k + 1).select("name", "leaf").toArrow()
    place = {int(n): {leaf: i for i, leaf in enumerate(tree.order(q, tree.n_leaves))} for n, q in zip(names, x)}
    needed = sorted(place[n][leaf] + 1 for n, leaf in zip(truth["name"].to_pylist(), truth["leaf"].to_pylist()))
    return needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]
