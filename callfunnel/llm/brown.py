"""Language-model scores by Brown classes: class transitions times word emissions.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, and one end token follows each text. Texts are
read once into blocks: a block holds a bounded number of words and tokens (or one longer text), its
distinct words as 64-bit hashes and its tokens as numbers into them. Everything later works on these.
Two unlike words among n count as one with probability under n * n / 2 ** 65.

Counts: every distinct training word is counted on the cluster, without a threshold. A block sends
its distinct words and their training counts to ranges of hashes, and each range adds them up and
sends the totals back, so a word travels once a block, not once a token. There are as many ranges as
keep the words sent to one below a bound.

Classes: a word belongs to the class of its bucket, one of 2 ** 20 by hash, so the class table has
the same size (1 MB) whatever the vocabulary; words beyond that share classes, never counts. The
table starts at random and is improved by exchange: in each round the buckets of one residue are
held against the transitions between all classes, and each moves to the class in which the
likelihood of all training bigrams rises most. A task adds its blocks' neighbour classes up in one
dense table, and these sums are merged by range of buckets. The driver sees the
(classes + 1) ** 2 transitions and the class table. The best table of all rounds is kept.

Model: P(w | v) = P(class of w | class of v) * P(w | class of w). Transitions are smoothed towards
the class frequencies (weight `MU`), emissions by `ADD` a word with one place for all unknown words
of a class. The end token is a class of its own and also stands before the first word.

Null and empty texts are an end token. A row with a null id is not held out and is learnt from. Rows
with the same id keep their rows, and each counts. Without training rows the base score is 0. An
empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import drop_stored, stored

CLASSES = 32
BUCKET_BITS = 20
RESIDUES, SWEEPS = 4, 2
RANGE = 4096  # buckets of one residue that are decided together
MU, ADD = 10.0, 0.1
BLOCK_WORDS, BLOCK_TOKENS = 1 << 16, 1 << 20
RANGE_WORDS = 1 << 20  # words sent to a range of hashes, about
CHUNK = 1 << 20  # characters that are cut into words at once
END = b" "  # no word holds a space
END_HASH = np.uint64(xxhash.xxh3_64_intdigest(END))
GAP = re.compile("[\x20\x09-\x0d]")
BUCKETS = 1 << BUCKET_BITS


class _Local(dict):
    """Words by order of appearance."""

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k


def is_held_out(doc_id, every: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % every == 0


def token_blocks(docs: DataFrame, id_col: str, text_col: str, every: int) -> DataFrame:
    """(block, ids, held, sizes, tokens, words, n_words): see above; a text's tokens stay in one block."""
    kind = docs.schema[id_col].dataType.simpleString()
    numbers = pa.list_(pa.int64())

    def parts(text: str):
        at = 0
        while at < len(text):
            cut = GAP.search(text, at + CHUNK)
            end = cut.end() if cut else len(text)
            yield text[at:end].encode().lower().split()  # of bytes: A-Z, and the six white characters
            at = end

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        local, ids, sizes, tokens, held, total = _Local(), [], [], [], [], 0

        def out(id_type):
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, local), np.uint64, len(local))
            flat = np.concatenate(tokens).astype(np.uint16 if len(local) <= 1 << 16 else np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([sizes], numbers), pa.array([flat.tobytes()], pa.binary()), pa.array([hashes.tobytes()], pa.binary()),
                 pa.array([len(hashes)], pa.int64())],
                ["block", "ids", "held", "sizes", "tokens", "words", "n_words"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    size = 1
                    for words in parts(text or ""):
                        tokens.append(np.fromiter(map(local.__getitem__, words), np.uint32, len(words)))
                        size += len(words)
                    tokens.append(np.array([local[END]], np.uint32))
                    ids.append(doc)
                    held.append(is_held_out(doc, every))
                    sizes.append(size)
                    total += size
                    if len(local) >= BLOCK_WORDS - 8192 or total >= BLOCK_TOKENS:
                        yield out(batch.column(0).type)
                        number += 1
                        local, ids, sizes, tokens, held, total = _Local(), [], [], [], [], 0
        if ids:
            yield out(batch.column(0).type)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        run, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, tokens binary, words binary, n_words long")


@dataclass
class Block:
    words: np.ndarray
    tokens: np.ndarray
    sizes: np.ndarray
    train: np.ndarray  # per token

    @classmethod
    def of(cls, row: dict) -> Block:
        """From the columns held, sizes, tokens, words of one row."""
        words = np.frombuffer(row["words"], np.uint64)
        tokens = np.frombuffer(row["tokens"], np.uint16 if len(words) <= 1 << 16 else np.uint32)
        sizes = np.array(row["sizes"], np.int64)
        return cls(words, tokens, sizes, np.repeat(~np.array(row["held"], bool), sizes))

    def classes(self, table: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The class of every token and of the one before it (a text follows an end)."""
        now = word_classes(self.words, table, end)[self.tokens]
        return np.concatenate([[end], now[:-1]]), now


def buckets(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def word_classes(words: np.ndarray, table: np.ndarray, end: int) -> np.ndarray:
    return np.where(words == END_HASH, end, table[buckets(words)]).astype(np.int64)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


PARTS = ("held", "sizes", "tokens", "words")


def planes(x: np.ndarray) -> bytes:
    """Whole numbers byte by byte of equal weight, so that the bytes of small ones compress away."""
    return x.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def counted(blocks: DataFrame) -> DataFrame:
    """(block, range, counts): training tokens of a block's words in a range of hashes, in order of their hashes.

    Rows without a block hold, for each bucket, a range's distinct training words: (at, n) one after the other.
    """
    sent = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = np.uint64(64 - min(40, max(1, math.ceil(math.log2(max(sent, 1) / RANGE_WORDS)))))

    def send(batches):
        for row in _rows(batches):
            b = Block.of(row)
            n = np.bincount(b.tokens[b.train], minlength=len(b.words))
            order = np.argsort(b.words)
            words, n = b.words[order], n[order]
            ranges, starts = np.unique(words >> bits, return_index=True)
            for r, h, c in zip(ranges.tolist(), np.split(words, starts[1:]), np.split(n, starts[1:])):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r], pa.int64()), pa.array([row["block"]], pa.int64()),
                     pa.array([planes(np.diff(h.view(np.int64), prepend=0))], pa.binary()), pa.array([planes(c)], pa.binary())], ["range", "block", "words", "n"])

    def answer(rows: pa.Table) -> pa.Table:
        words = [np.cumsum(unplanes(w)).view(np.uint64) for w in rows["words"].to_pylist()]
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, np.concatenate([unplanes(n) for n in rows["n"].to_pylist()]))
        ends = np.cumsum([len(w) for w in words])[:-1]
        bucket, n = np.unique(buckets(distinct[(total > 0) & (distinct != END_HASH)]), return_counts=True)
        return pa.table({"block": pa.array([*rows["block"].to_pylist(), None], pa.int64()),
                         "range": pa.array([*rows["range"].to_pylist(), None], pa.int64()),
                         "counts": pa.array([*map(planes, np.split(total[place], ends)), planes(np.concatenate([bucket, n]))], pa.binary())})

    return (blocks.select("block", *PARTS).mapInArrow(send, "range long, block long, words binary, n binary")
            .groupBy("range").applyInArrow(answer, "block long, range long, counts binary"))


def added_up(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of rows (at, n) by place, of a fixed number of places."""
    got = rows.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[got["at"].to_numpy()] = got["n"].to_numpy()
    return out


def _places(total: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])


def transitions(blocks: DataFrame, table, classes: int) -> np.ndarray:
    """Training bigrams by (class before, class); the last class is the end."""
    side = classes + 1

    def run(batches):
        total = np.zeros(side * side, np.int64)
        for row in _rows(batches):
            b = Block.of(row)
            before, now = b.classes(table.value, classes)
            total += np.bincount((before * side + now)[b.train], minlength=side * side)
        yield _places(total)

    return added_up(blocks.select(*PARTS).mapInArrow(run, "at long, n long"), side * side).reshape(side, side)


def vocabulary(counts: DataFrame) -> np.ndarray:
    """Distinct training words by bucket."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                at, n = unplanes(data.as_py()).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["at", "n"])

    return added_up(counts.filter("block IS NULL").select("counts").mapInArrow(run, "at long, n long"), BUCKETS)


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(bigrams: np.ndarray) -> float:
    """Of the training bigrams, but for a term that classes don't change."""
    return float(xlogx(bigrams).sum() - xlogx(bigrams.sum(axis=0)).sum() - xlogx(bigrams.sum(axis=1)).sum())


def neighbours(blocks: DataFrame, table, classes: int, residue: int, salts: int) -> DataFrame:
    """(range, salt, sums): neighbour classes of the residue's buckets, one row per task and range.

    A bucket's line is: how often each class follows it, then how often each class stands before it.
    """
    side, spread = classes + 1, BUCKETS // RESIDUES

    def run(batches):
        total = np.zeros(spread * 2 * side, np.uint32)
        for row in _rows(batches):
            b = Block.of(row)
            before, now = b.classes(table.value, classes)
            bucket = np.where(b.words == END_HASH, -1, buckets(b.words))
            moving = (bucket % RESIDUES == residue) & (bucket >= 0)
            line = np.where(moving, bucket // RESIDUES * (2 * side), -1)[b.tokens]
            line[~b.train] = -1
            at = np.flatnonzero(line >= 0)
            for places in (line[at] + now[at + 1], line[at] + side + before[at]):  # a word has a next token: the end at least
                place, n = np.unique(places, return_counts=True)
                total[place] += n.astype(np.uint32)
        salt = TaskContext.get().partitionId() % salts
        for r, sums in enumerate(total.reshape(-1, RANGE * 2 * side)):
            if sums.any():
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([salt], pa.int32()), pa.array([packed(sums)], pa.binary())],
                                                 ["range", "salt", "sums"])

    return blocks.select(*PARTS).mapInArrow(run, "range int, salt int, sums binary")


def packed(sums: np.ndarray) -> bytes:
    """Places and values of the entries that aren't 0."""
    at = np.flatnonzero(sums)
    return zlib.compress(np.concatenate([np.diff(at, prepend=0), sums[at]]).astype(np.int64).tobytes(), 1)


def add_packed(total: np.ndarray, data: bytes) -> None:
    both = np.frombuffer(zlib.decompress(data), np.int64).reshape(2, -1)
    total[np.cumsum(both[0])] += both[1]


def best_classes(lines: np.ndarray, own: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """Per line of neighbour classes the class that raises the likelihood most; its own where none does.

    A line is first taken out of its class, then held against every class.
    """
    side = len(bigrams)
    classes, m = side - 1, bigrams.astype(np.float64)
    out, rows = own.copy(), np.flatnonzero(lines.any(axis=1))
    if not len(rows):
        return out
    gain = np.zeros((len(rows), classes))
    size = lines[rows, :side].sum(axis=1).astype(np.float64)
    mine, every = own[rows], np.arange(len(rows))
    for half, table in ((lines[rows, :side], m[:classes]), (lines[rows, side:], m[:, :classes].T)):
        for at in range(0, len(rows), 512):
            line, context = np.nonzero(half[at:at + 512])
            n = half[at:at + 512][line, context].astype(np.float64)[:, None]
            held = table[:, context].T
            held = held - np.where(np.arange(classes) == mine[at:at + 512][line][:, None], n, 0)
            np.add.at(gain, at + line, xlogx(held + n) - xlogx(held))
    for totals in (m.sum(axis=1)[:classes], m.sum(axis=0)[:classes]):
        held = np.broadcast_to(totals, gain.shape).copy()
        held[every, mine] -= size
        gain -= xlogx(held + size[:, None]) - xlogx(held)
    best = gain.argmax(axis=1)
    moves = gain[every, best] > gain[every, mine] + 1e-6
    out[rows[moves]] = best[moves]
    return out


def exchange(blocks: DataFrame, table: np.ndarray, bigrams: np.ndarray, residue: int, salts: int) -> np.ndarray:
    """The table after the residue's buckets have moved."""
    classes = len(bigrams) - 1
    width, spark = 2 * len(bigrams), blocks.sparkSession
    shared, model = spark.sparkContext.broadcast(table), spark.sparkContext.broadcast((table[residue::RESIDUES], bigrams))

    def total_of(batches) -> np.ndarray:
        total = np.zeros(RANGE * width, np.int64)
        for batch in batches:
            for sums in batch.column("sums"):
                add_packed(total, sums.as_py())
        return total

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([packed(total_of(batches))], pa.binary())], ["range", "sums"])

    def decide(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bigrams = model.value
        at = key[0].as_py()
        moved = best_classes(total_of(batches).reshape(RANGE, width), own[at * RANGE:(at + 1) * RANGE].astype(np.int64), bigrams)
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([moved.astype(np.uint8).tobytes()], pa.binary())], ["range", "classes"])

    # by the types of its arguments Spark knows that such a function takes its group as a stream
    sums = neighbours(blocks, shared, classes, residue, salts)
    if salts > 1:
        sums = sums.groupBy("range", "salt").applyInArrow(merge, "range int, sums binary")
    moved = sums.groupBy("range").applyInArrow(decide, "range int, classes binary").toArrow()  # the class table: a byte a bucket
    out = table.copy()
    for at, some in zip(moved["range"].to_pylist(), moved["classes"].to_pylist()):
        out[residue::RESIDUES][at * RANGE:(at + 1) * RANGE] = np.frombuffer(some, np.uint8)
    shared.destroy()
    model.destroy()
    return out


@dataclass
class Model:
    """The class table, transitions and the figures of emission by class; totals of the training tokens."""

    table: np.ndarray
    bigrams: np.ndarray
    words: np.ndarray  # distinct ones by class
    n_tokens: int
    n_words: int

    def log_transitions(self) -> np.ndarray:
        now = self.bigrams.sum(axis=0)
        share = (now + 1) / (now.sum() + len(now))
        return np.log10((self.bigrams + MU * share) / (self.bigrams.sum(axis=1)[:, None] + MU))

    def log_emissions(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        size = self.bigrams.sum(axis=0)
        out = np.log10((counts + ADD) / (size[classes] + ADD * (self.words[classes] + 1)))
        return np.where(classes == len(size) - 1, 0.0, out)  # the end is alone in its class

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADD) / (self.n_tokens + ADD * (self.n_words + 1)))


def fit(blocks: DataFrame, counts: DataFrame, classes: int = CLASSES, sweeps: int = SWEEPS, seed: int = 17) -> Model:
    """Classes by exchange over all training bigrams, then the model's figures."""
    context = blocks.sparkSession.sparkContext
    salts = max(1, math.isqrt(blocks.count() // 64))
    table, best = np.random.default_rng(seed).integers(0, classes, BUCKETS).astype(np.uint8), None
    for step in range(sweeps * RESIDUES + 1):
        shared = context.broadcast(table)
        bigrams = transitions(blocks, shared, classes)
        value = likelihood(bigrams)
        if best is None or value > best[0]:
            best = value, table, bigrams
        shared.destroy()
        if step < sweeps * RESIDUES:
            table = exchange(blocks, table, bigrams, step % RESIDUES, salts)
    _, table, bigrams = best
    by_bucket, n_tokens = vocabulary(counts), int(bigrams.sum())
    words = np.bincount(table, weights=by_bucket, minlength=classes).astype(np.int64)
    end = int(n_tokens > 0)
    return Model(table, bigrams, np.append(words, end), n_tokens, int(words.sum()) + end)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, sweeps: int = SWEEPS,
           every: int = 10) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity (of a token)."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    blocks = stored(token_blocks(docs, id_col, text_col, every), "blocks")
    counts = stored(counted(blocks), "counts")
    model = spark.sparkContext.broadcast(fit(blocks, counts, classes, sweeps))

    def score(mine: pa.Table, known: pa.Table) -> pa.Table:
        out = []
        m = model.value
        end = len(m.words) - 1
        for row in _rows(mine.to_batches()):
            b = Block.of(row)
            parts = sorted(zip(known["range"].to_pylist(), known["counts"].to_pylist()))
            c = np.empty(len(b.words), np.int64)
            c[np.argsort(b.words)] = np.concatenate([unplanes(n) for _, n in parts])
            before, now = b.classes(m.table, end)
            log = m.log_emissions(word_classes(b.words, m.table, end), c)[b.tokens] + m.log_transitions()[before, now]
            starts = np.cumsum(b.sizes) - b.sizes
            total = np.add.reduceat(log, starts)
            out.append(pa.table({
                "doc_id": pa.array(row["ids"], mine.schema.field("ids").type.value_type), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": b.sizes,
                "n_known": np.add.reduceat((c > 0)[b.tokens].astype(np.int64), starts), "train_tokens": np.full(len(starts), m.n_tokens),
                "base_score": np.add.reduceat(m.log_base(c)[b.tokens], starts), "score": total, "perplexity": 10 ** np.minimum(-total / b.sizes, 300)}))
        return pa.concat_tables(out) if out else pa.schema([("doc_id", mine.schema.field("ids").type.value_type)]).empty_table()

    out = blocks.groupBy("block").cogroup(counts.filter("block IS NOT NULL").groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
    result = stored(out, "scores")
    drop_stored(spark, blocks, counts)
    return result
