"""Near-duplicate classes by an LSH forest over MinHash signatures, with exact confirmation.

A text's set is its distinct word shingles (A-Z lower-cased; a text with fewer words is one
shingle; without words the set is empty and links with nothing). Texts with equal sets form one
class, so copies cost one row from there on.

A tree is a sorted order of the classes by `depth` and more MinHash values; every tree starts at
another value of the signature. `forest` chooses the least depth from the number of documents, so
that unlike texts seldom agree on it, and as many trees as make classes with similarity 0.8 agree
on the first `depth` values of some tree with probability 0.999997 or more.

1. Forest neighbours: for some trees the labels are range-sorted over the cluster and each class is
   paired with the next one if their common prefix is at least `depth` long. How deep that prefix
   goes adapts to the region: sorting puts the deepest match next, however crowded the region is.
   Large groups of near copies become connected this way with a linear number of pairs.
2. Regions: for every tree, regions (equal first `depth` values) whose classes are not yet in one
   component are searched again: members outside the region's main component against each other,
   and against that component's members, in blocks of bounded size. Blocks give out links only, no
   pairs, and stop at the first link between two components.

Links are confirmed on whole sets; neighbours must first pass a size test (exact) and a one-bit
sketch test that rejects a true link with probability under 1e-7. Components come from alternating
star contraction, on the cluster, one written table per round.

Classes are known by 64 bits of a digest of their set: two unlike texts among n are taken for
copies with probability under n * n / 2 ** 65.

Null text counts as empty. A row with a null id takes its class's component but never gives the
id; a class of null ids only has a null component, and its rows are kept. Repeated rows are in one
class; rows that share an id but not a text stay apart. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import TEXT_ROWS, drop_stored, stored

SORTED_TREES = 6
TAIL = 6  # further values that order a region in the sorted trees
MISSED = 3e-6  # share of links at similarity 0.8 that no tree may show
BITS = 256  # of the sketch: one of each of as many MinHash values
BITS_APART = 60  # at similarity 0.8 the mean is 25.6, the deviation 4.8
BLOCK = 256  # classes of a block in the second search
KEY_BITS = 24  # log2 of the most bits of a key filter, 4 MB as a table
KNOWN_WORDS = 60_000  # memory bound of the word-hash memo; it is emptied when full

MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
SKETCH = ("b1", "b2", "b3", "b4")


def forest(n_docs: int) -> tuple[int, int]:
    """(trees, depth): one more value for each factor of about thirty in the number of documents."""
    depth = min(8, max(4, math.ceil(math.log10(max(n_docs, 1)) / 1.5)))
    return math.ceil(math.log(MISSED) / math.log(1 - 0.8 ** depth)), depth


def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    multiply = (rng.integers(0, 1 << 31, count, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
    return multiply, rng.integers(0, 1 << 32, count, dtype=np.uint64).astype(np.uint32)[:, None]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, known: dict, size: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of `size` words."""
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
    k = min(size, len(h))
    mixed = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):  # order matters: each step multiplies what came before
        mixed = (mixed ^ h[i:len(h) - k + 1 + i]) * MIX[0]
        mixed ^= mixed >> np.uint64(29)
    mixed = (mixed * MIX[1]) ^ (mixed >> np.uint64(32)) * MIX[2]
    return np.unique(mixed)


def signature(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """MinHash values of a non-empty set; very long sets are taken in blocks."""
    multiply, add = functions
    best = np.full(len(multiply), 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(best, (x[None, at:at + 2048] * multiply + add).min(axis=1), out=best)
    return best


def _name(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def features(docs: DataFrame, id_col: str, text_col: str, shingle: int, values: int) -> DataFrame:
    """doc_id, n (set size), node (name of the set), sig (its first `values` MinHash values), b1..b4 (the sketch)."""
    kind = docs.schema[id_col].dataType.simpleString()
    count = max(values, BITS)

    def run(batches):
        known, functions = _Hashes(), hash_functions(count)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, node, sigs = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(text, known, shingle)
                    n.append(len(s))
                    node.append(_name(s) if len(s) else None)
                    sigs.append(signature(s, functions) if len(s) else np.zeros(count, np.uint32))
                sig = np.array(sigs)
                sketch = np.packbits((sig[:, :BITS] & 1).astype(np.uint8), axis=1).view(np.int64)
                sig = np.ascontiguousarray(sig[:, :values])
                offsets = np.arange(0, (len(sig) + 1) * values, values, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.view(np.int32).ravel())),
                     *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(4))],
                    ["doc_id", "n", "node", "sig", *SKETCH])

    return (docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
            .mapInArrow(run, f"doc_id {kind}, n long, node long, sig array<int>, b1 long, b2 long, b3 long, b4 long"))


def forest_neighbours(classes: DataFrame, depth: int) -> DataFrame:
    """Pairs (a, b) of classes next to each other in a sorted tree, at least `depth` values alike."""
    size = F.size("sig")
    at = lambda k: F.element_at("sig", ((F.col("tree") * depth + k) % size + 1).cast("int"))
    trees = F.explode(F.sequence(F.lit(0), F.lit(SORTED_TREES - 1)))
    labels = (classes.select("node", "n", "sig", *SKETCH, trees.alias("tree"))
              .select("tree", F.xxhash64(*[at(k) for k in range(depth)]).alias("head"),  # only ever compared for equality
                      F.array(*[at(depth + k) for k in range(TAIL)]).alias("tail"), "node", "n", *SKETCH))
    order = ["tree", "head", "tail", "node"]
    names = ["tree", "head", "tail", "node", "n", *SKETCH]
    layout = "a long, b long, tree int, head long, tail array<int>, node long, n long, b1 long, b2 long, b3 long, b4 long"

    def run(batches):
        """Pairs inside the partition; its first and last row, for the pairs across partitions."""
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).select(names)
            if last is None:
                yield from padded(rows.slice(0, 1))
            else:
                rows = pa.concat_tables([last, rows])
            n = rows.num_rows
            head = np.column_stack([rows["tree"].to_numpy(), rows["head"].to_numpy()])
            found = np.flatnonzero((head[1:] == head[:-1]).all(axis=1))
            if len(found):
                found = found[_alike(*[(rows["n"].to_numpy()[found + k], np.column_stack([rows[b].to_numpy()[found + k] for b in SKETCH])) for k in (0, 1)])]
            if len(found):
                node = rows["node"].to_numpy()
                yield from padded(pa.table({"a": node[found], "b": node[found + 1]}))
            last = rows.slice(n - 1, 1)
        if last is not None:
            yield from padded(last)

    numbers = pa.list_(pa.int32())
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("head", pa.int64()), ("tail", numbers),
                        ("node", pa.int64()), ("n", pa.int64()), *((b, pa.int64()) for b in SKETCH)])

    def padded(t: pa.Table):
        return pa.table([t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(t.num_rows, f.type) for f in schema], schema=schema).combine_chunks().to_batches()

    found = stored(labels.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, layout), "forest")
    inside = found.filter("a IS NOT NULL").select("a", "b")
    edges = found.filter("node IS NOT NULL").select(*names).dropDuplicates(["tree", "node"])  # two rows a partition
    nxt = "lead({}) OVER (ORDER BY tree, head, tail, node)"
    across = (edges.select(F.col("node").alias("a"), F.expr(nxt.format("node")).alias("b"), "tree", "head",
                           F.expr(nxt.format("tree")).alias("tree2"), F.expr(nxt.format("head")).alias("head2"))
              .filter("tree = tree2 AND head = head2").select("a", "b"))
    return _ordered(inside.unionByName(across))


def _alike(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether sizes and sketches leave a similarity of 0.8 possible."""
    low, high = np.minimum(x[0], y[0]), np.maximum(x[0], y[0])
    apart = np.bitwise_count((x[1] ^ y[1]).view(np.uint64)).astype(np.int64).sum(axis=-1)  # of signed numbers it would count the magnitude
    return (100 * low >= 80 * high) & (apart <= BITS_APART)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(x) + len(y) - len(np.union1d(x, y))
    return 100 * both >= percent * (len(x) + len(y) - both)


class _Overlaps:
    """A block of sets by element, so that one set is compared with all of them at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.size)
        order = np.argsort(every, kind="stable")
        self.owner = owner[order]
        self.element, first = np.unique(every[order], return_index=True)
        self.start = np.append(first, len(every))

    def linked(self, mine: np.ndarray, percent: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.element, mine), len(self.element) - 1)
        at = at[self.element[at] == mine]
        start, count = self.start[at], self.start[at + 1] - self.start[at]
        places = np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)
        both = np.bincount(self.owner[places], minlength=len(self.size))
        return 100 * both >= percent * (len(mine) + self.size - both)


def key_filter(keys: DataFrame, *cols: str):
    """A function (df, columns) -> (rows that may have one of the keys, rows that surely have none).

    Keys are hashed to about eight bits each, 64 bits to a row of a table of at most 2^18 rows, so that rows
    which can't join are told without a shuffle, however many keys there are. An exact join has to follow.
    """
    bits = min(KEY_BITS, max(10, (8 * keys.count()).bit_length()))
    at = lambda names: F.pmod(F.xxhash64(*names), F.lit(1 << bits))
    words = stored(keys.select(at(cols).alias("_at")).groupBy(F.shiftright("_at", 6).alias("_word"))
                   .agg(F.expr("bit_or(shiftleft(1L, CAST(_at & 63 AS INT)))").alias("_bits")), "filter")

    def split(df: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
        marked = df.withColumn("_at", at(names)).join(F.broadcast(words), F.shiftright("_at", 6) == F.col("_word"), "left")
        may = F.expr("coalesce(shiftright(_bits, CAST(_at & 63 AS INT)) & 1, 0) = 1")
        return marked.filter(may).select(*df.columns), marked.filter(~may).select(*df.columns)

    return split


def whole_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(node, members): the sets of the nodes, as 64-bit hashes, made again from one text of each class."""
    wanted = stored(classes.select("node", "rep").join(nodes.select("node").distinct(), "node", "left_semi"), "wanted")
    texts, _ = key_filter(wanted, "rep")(docs.select(docs[id_col].alias("rep"), docs[text_col].alias("text")), "rep")
    texts = texts.join(wanted.select("rep").distinct(), "rep", "left_semi")

    def sets(batches):
        known = _Hashes()
        for batch in batches:
            got = [shingle_set(t, known, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_name(s) for s in got], pa.int64()),
                                              pa.array([s.tobytes() for s in got], pa.binary())], ["rep", "node", "members"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = (texts.mapInArrow(sets, f"rep {kind}, node long, members binary").join(wanted, ["rep", "node"], "left_semi")
             .dropDuplicates(["node"]))
    out = stored(found.select("node", "members"), "sets", TEXT_ROWS)
    drop_stored(docs.sparkSession, wanted)
    return out


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets have 100 * intersection >= percent * union."""
    def check(batches):
        for batch in batches:
            keep = [_linked(*(np.frombuffer(v.as_buffer(), np.uint64) for v in p), percent) for p in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_sets = (pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("sa")), "a")
                 .join(sets.select(F.col("node").alias("b"), F.col("members").alias("sb")), "b").select("a", "b", "sa", "sb"))
    return with_sets.mapInArrow(check, "a long, b long")


def region_links(classes: DataFrame, components: DataFrame, trees: int, depth: int, percent: int, sets_of) -> DataFrame:
    """Links (a, b) between different components among the classes that share a region of some tree."""
    heads = F.array(*[F.xxhash64(F.lit(t), F.slice("sig", t * depth + 1, depth)) for t in range(trees)])
    # classes without a link so far are components of their own; only the others are joined
    rows = classes.select("node", "sig").join(components, "node", "left").select(
        F.explode(heads).alias("region"), "node", F.coalesce("component", "node").alias("component"))
    mixed = stored(rows.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .filter("lo <> hi").select("region"), "mixed")
    members = stored(key_filter(mixed, "region")(rows, "region")[0].join(mixed, "region", "left_semi"), "members")
    main = (members.groupBy("region", "component").agg(F.count("*").alias("size"))
            .groupBy("region").agg(F.max_by("component", F.struct("size", "component")).alias("main")))
    minors = stored(members.join(main, "region").filter("component <> main"), "minors")
    asked = stored(minors.select("node", F.col("component").alias("own"), F.col("main").alias("group")).distinct(), "asked")
    groups = asked.select("group").distinct()
    held = groups.join(components.withColumnRenamed("component", "group"), "group", "left").select(F.coalesce("node", "group").alias("node"), "group")
    held = stored(held, "held")
    sets = sets_of(held.select("node").unionByName(minors.select("node")))

    # minors against the members of their regions' main components
    sizes = held.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    probes = asked.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("probe_blocks"))
    shape = stored(sizes.join(probes, "group"), "shape")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    single = ((F.col("blocks") == 1) & (F.col("probe_blocks") == 1)).alias("small")
    left = asked.join(shape, "group").select("group", block("probe_blocks").alias("i"), every("blocks").alias("j"), "node", "own", single)
    right = (held.join(shape, "group").withColumn("j", block("blocks"))
             .select("group", every("probe_blocks").alias("i"), "j", "node", F.col("group").alias("own"), single))
    # minors of a region against each other
    sizes = (minors.groupBy("region").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo <> hi").select(F.col("region").alias("group"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    own = (minors.select(F.col("region").alias("group"), "node", F.col("component").alias("own"))
           .join(stored(sizes, "shape"), "group").withColumn("at", block("blocks")))
    small = F.col("blocks") == 1
    upper = own.select("group", F.col("at").alias("i"), F.explode(F.sequence(F.col("at"), F.col("blocks") - 1)).alias("j"), "node", "own", small.alias("small"))
    lower = own.select("group", F.explode(F.sequence(F.lit(0), F.col("at"))).alias("i"), F.col("at").alias("j"), "node", "own", small.alias("small"))
    # groups of one block share buckets of about BLOCK rows, as a task call for each would cost more than its work
    buckets = max(1, (minors.count() + asked.count()) // BLOCK)
    bucket = F.when(F.col("small"), F.pmod(F.xxhash64("kind", "group"), F.lit(buckets))).otherwise(F.xxhash64("kind", "group", "i", "j"))
    tag = lambda df, kind: df.withColumn("kind", F.lit(kind))
    left = tag(left, 0).unionByName(tag(upper, 1)).withColumn("bucket", bucket).join(sets, "node")
    other = sets.select(*[F.col(c).alias(c) for c in sets.columns])  # columns of their own for the other side
    right = tag(right, 0).unionByName(tag(lower, 1)).withColumn("bucket", bucket).join(other, "node")

    def parts(rows: pa.Table) -> dict:
        out: dict[tuple, list[int]] = {}
        for at, key in enumerate(zip(*(rows[c].to_pylist() for c in ("kind", "group", "i", "j")))):
            out.setdefault(key, []).append(at)
        return out

    def columns(rows: pa.Table, at: list[int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        members = rows["members"]
        return rows["node"].to_numpy()[at], rows["own"].to_numpy()[at], [np.frombuffer(members[k].as_buffer(), np.uint64) for k in at]

    def search(_, asking: pa.Table, there: pa.Table) -> pa.Table:
        a, b = [], []
        held_rows = parts(there) if there.num_rows else {}
        for key, rows in (parts(asking) if held_rows and asking.num_rows else {}).items():
            if key not in held_rows:
                continue
            node, own, sets = columns(there, held_rows[key])
            shared, same = _Overlaps(sets), {}

            def root(c, same=same):
                while same.setdefault(c, c) != c:
                    c = same[c]
                return c

            for mine, mine_own, members in zip(*columns(asking, rows)):
                for k in np.flatnonzero(shared.linked(members, percent) & (own != mine_own)):
                    if root(mine_own) != root(own[k]):
                        same[root(mine_own)] = root(own[k])
                        a.append(mine)
                        b.append(node[k])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    links = stored(left.groupBy("bucket").cogroup(right.groupBy("bucket")).applyInArrow(search, "a long, b long"), "links")
    drop_stored(classes.sparkSession, mixed, members, minors, asked, held, shape, sets)
    return links


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): component is the smallest node reachable.

    Alternating star contraction: `big > small` edges; a large-star round hangs larger neighbours on
    the smallest one, a small-star round does so with smaller neighbours. Ends when nothing changes.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"))
                   .filter("big <> small").distinct(), "edges")
    spark, state = edges.sparkSession, None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
        both = edges.select(F.col("big").alias("u"), F.col("small").alias("v")).unionByName(
            edges.select(F.col("small").alias("u"), F.col("big").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = stored(both.join(lowest, "u").filter("v > u").select(F.col("v").alias("big"), F.col("low").alias("small")).distinct(), "large")
        lowest = large.groupBy("big").agg(F.min("small").alias("low"))
        hung = large.join(lowest, "big").select("big", "small", "low")
        small = hung.select("big", F.col("low").alias("small")).unionByName(
            hung.filter("small <> low").select(F.col("small").alias("big"), F.col("low").alias("small"))).distinct()
        old, edges = edges, stored(small, "small")
        drop_stored(spark, old, large)
    return edges.select(F.col("big").alias("node"), F.col("small").alias("component")).unionByName(
        edges.select(F.col("small").alias("node"), F.col("small").alias("component")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id)."""
    spark = docs.sparkSession
    trees, depth = forest(docs.count())
    rows = stored(features(docs, id_col, text_col, shingle, trees * depth), "features", TEXT_ROWS)
    classes = stored(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"),
        *[F.any_value(b).alias(b) for b in SKETCH]), "classes")
    usable = classes.filter("rep IS NOT NULL")

    def sets_of(nodes: DataFrame) -> DataFrame:
        return whole_sets(nodes, usable, docs, id_col, text_col, shingle)

    pairs = stored(forest_neighbours(usable, depth), "pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    first = stored(confirmed(pairs, sets, percent), "links")
    drop_stored(spark, sets, pairs)
    joined = stored(connected(first), "joined")
    more = region_links(usable, joined, trees, depth, percent, sets_of)
    final = stored(connected(joined.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
                             .unionByName(more)), "final")
    named = classes.select("node", "rep").join(final, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), "rep")
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    ids = stored(named.join(lowest, "component").select("node", "component_id"), "ids")
    drop_stored(spark, classes, first, more, joined, final)
    return (rows.select("doc_id", "n", "node").join(ids, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` to keep: one text of each class, that of its smallest id; columns unchanged.

    Verdicts are by id and text, so rows that share an id stand or go each by its text. Of rows that
    repeat the same id and text one stays, rows without an id all stay. Keys that go are written
    first, so the planner knows their size: few are broadcast, many are joined by key, with those
    texts alone that a filter of the keys lets through.
    """
    name = F.xxhash64(docs[text_col])
    keyed = docs.select(F.when(docs[id_col].isNotNull(), F.struct(docs[id_col].alias("id"), name.alias("name"))).alias("key"), docs[text_col].alias("text"))
    verdicts = near_duplicates(keyed, "key", "text", shingle, percent)
    gone = stored(verdicts.filter("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id.id").alias("_gone"), F.col("doc_id.name").alias("_name")).distinct(), "gone")
    may, stay = key_filter(gone, "_gone", "_name")(docs.withColumn("_text_name", name), id_col, "_text_name")
    may = may.join(gone, (may[id_col] == gone["_gone"]) & (may["_text_name"] == gone["_name"]), "left_anti")
    left = stay.unionByName(may).drop("_text_name")
    named = left.filter(left[id_col].isNotNull())
    twice = stored(named.groupBy(named[id_col].alias("_id")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_id"), "twice")
    if twice.isEmpty():
        return left  # the texts are read half as often
    once = left.join(twice, left[id_col] == twice["_id"], "left_anti")
    again = named.join(twice, named[id_col] == twice["_id"], "left_semi").dropDuplicates([id_col, text_col])
    return once.unionByName(again)
