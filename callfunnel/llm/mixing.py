"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

A source's weight is its token share to the power alpha, normalised. Alpha in [0, 1] is bisected:
the largest at which the mixture's entropy reaches the target, raised if a source would otherwise
be repeated more often than allowed. Each source gets weight x budget tokens: whole epochs, then a
part of one more. A source is cut into blocks by hash and every epoch visits the blocks in another
permutation; the last epoch takes blocks, then documents of one block, until the budget is reached
(the document that crosses it is the last one).

The sources stay on the cluster, however many they are: the bisection only asks for sums of powers of
the shares, for several exponents a pass. Blocks hold about `block_tokens` tokens, so their number follows
the source's size; their running sums are taken over ranges of the permutation.

A token is a word; a text without words (null or empty too) costs one. A null source is a source of
its own. Repeated rows share their place in the order and are taken or left together. An empty
table gives an empty table. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import stored, whole, words

CUTS, PASSES = 15, 13  # exponents tried in a pass; 16 ** 13 parts of [0, 1]
RANGE_BITS = 10  # of the 60 bits of a block's place: the ranges of its running sum

#: For some exponents a: the sums over sources of p^a and of p^a ln p, p being a source's share.
Moments = Callable[[list[float]], list[tuple[float, float]]]


def entropy(alpha: float, powers: float, logs: float) -> float:
    """Of the mixture at `alpha`, from its moments."""
    return math.log(powers) - alpha * logs / powers


def repeats(alpha: float, powers: float, smallest: float, budget: float) -> float:
    """Epochs of the source that is seen most often, the one with the smallest share, for a budget in corpora."""
    return budget * smallest ** (alpha - 1.0) / powers


def bisect(reached: Callable[[list[float]], list[bool]]) -> float:
    """The largest number in [0, 1] at which `reached` still holds, if it holds up to some number."""
    low, high = 0.0, 1.0
    if reached([high])[0]:
        return high
    for _ in range(PASSES):
        inner = [low + (high - low) * i / (CUTS + 1) for i in range(1, CUTS + 1)]
        ends = [low, *inner, high]
        n = sum(reached(inner))
        low, high = ends[n], ends[n + 1]
    return low


def exponent(moments: Moments, n_sources: int, smallest: float, budget: float, entropy_share: float, max_repeats: float) -> float:
    """Alpha for an entropy of `entropy_share` of the highest possible, and `max_repeats` epochs at most."""
    if n_sources < 2:
        return 1.0
    target = entropy_share * math.log(n_sources)
    alpha = bisect(lambda tried: [entropy(a, *m) >= target for a, m in zip(tried, moments(tried))])
    few = lambda tried: [repeats(a, m[0], smallest, budget) <= max_repeats for a, m in zip(tried, moments(tried))]
    if few([alpha])[0]:
        return alpha
    return 1.0 - bisect(lambda tried: few([1.0 - a for a in tried]))


def plans(sizes: DataFrame, budget: float = 1.0, entropy_share: float = 0.95, max_repeats: float = 4.0,
          block_tokens: int = 1 << 18) -> DataFrame:
    """Per source of `sizes` (source, n): n_blocks, epochs (whole ones), rest (tokens of the epoch after them), all long.

    The budget is a multiple of the corpus. One row reaches the driver in each pass.
    """
    total, k, least = sizes.agg(F.sum("n"), F.count("*"), F.min("n")).first()
    share = F.col("n") / F.lit(float(total or 1))

    def moments(tried: list[float]) -> list[tuple[float, float]]:
        powers = [F.pow(share, F.lit(a)) for a in tried]
        row = sizes.agg(*[F.sum(p) for p in powers], *[F.sum(p * F.log(share)) for p in powers]).first()
        return list(zip(row[:len(tried)], row[len(tried):]))

    alpha = exponent(moments, k, (least or 1) / float(total or 1), budget, entropy_share, max_repeats)
    powers = moments([alpha])[0][0] if k else 1.0
    tokens = F.floor(F.pow(share, F.lit(alpha)) / F.lit(powers) * F.lit(budget * (total or 0)) + 0.5)
    return (sizes.withColumn("tokens", tokens.cast("long"))
            .select("source", F.expr(f"(n + {block_tokens - 1}) div {block_tokens}").alias("n_blocks"),
                    F.expr("tokens div n").alias("epochs"), F.expr("tokens % n").alias("rest")))


def number(*parts: Column | str | int) -> Column:
    """60 bits of the MD5 of the parts."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 1,
        **targets) -> DataFrame:
    """`docs` repeated to the mixture, with `epoch` and `block_order`: training order is source-wise
    (epoch, block_order), both numbers being the same for a block's documents."""
    names = [f"`{c}`" for c in docs.columns]
    row = docs.select(F.struct(*[docs[n] for n in names]).alias("row"), docs[source_col].cast("string").alias("_source"),
                      F.greatest(F.size(words(whole(docs[text_col]))), F.lit(1)).cast("long").alias("_cost"),
                      number(seed, F.coalesce(docs[id_col].cast("string"), F.lit("-")), F.md5(whole(docs[text_col]))).alias("_h"))
    light = row.select("_source", "_cost", "_h")
    sizes = stored(light.groupBy(F.col("_source").alias("source")).agg(F.sum("_cost").alias("n")), "sizes")
    # written, so the planner knows its size: broadcast if small, else joined by source, where AQE splits a hot one
    plan = stored(plans(sizes, **targets).withColumnRenamed("source", "p_source"), "plan")
    same = F.col("_source").eqNullSafe(F.col("p_source"))
    block = F.pmod(number(seed, "block", F.col("_h")), F.col("n_blocks"))
    name = F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit("-"))
    placed = light.join(plan, same).withColumn("block", block)
    blocks = (placed.groupBy("_source", "block", "epochs", "rest").agg(F.sum("_cost").alias("tokens"))
              .withColumn("order", number(seed, name, F.col("epochs"), F.col("block")))
              .withColumn("range", F.shiftright("order", 60 - RANGE_BITS)))
    running = "sum({}) OVER (PARTITION BY {} ORDER BY {} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    blocks = stored(blocks, "orders")
    ranges = blocks.groupBy(F.col("_source").alias("r_source"), F.col("range").alias("r_range")).agg(F.sum("tokens").alias("r_tokens"))
    ranges = ranges.withColumn("r_before", F.expr(running.format("r_tokens", "r_source", "r_range")) - F.col("r_tokens"))
    blocks = blocks.join(ranges, F.col("_source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")))
    blocks = blocks.withColumn("upto", F.col("r_before") + F.expr(running.format("tokens", "_source, range", "`order`")))
    blocks = stored(blocks.filter("upto - tokens < rest").select(
        F.col("_source").alias("b_source"), F.col("block").alias("b_block"), (F.col("upto") - F.col("tokens")).alias("before"),
        "tokens", "rest"), "blocks")
    # the one block of a source that its budget ends in: documents up to a hash are taken
    cut = blocks.filter("before + tokens > rest").select("b_source", "b_block", (F.col("rest") - F.col("before")).alias("room"))
    inside = placed.join(cut, F.col("_source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block"))).groupBy(
        "b_source", "b_block", "room", "_h").agg(F.sum("_cost").alias("cost"))
    inside = inside.withColumn("upto", F.expr(running.format("cost", "b_source, b_block", "_h")))
    last = stored(inside.filter("upto - cost < room").groupBy("b_source", "b_block").agg(F.max("_h").alias("last")), "cut")
    taken = blocks.join(last.select(F.col("b_source").alias("c_source"), F.col("b_block").alias("c_block"), "last"),
                        F.col("b_source").eqNullSafe(F.col("c_source")) & (F.col("b_block") == F.col("c_block")), "left"
                        ).select(F.struct("b_source", "b_block").alias("key"), "last")
    taken = stored(taken, "taken")
    out = (row.join(plan, same).withColumn("block", block)
           .withColumn("b_key", F.struct(F.col("_source").alias("b_source"), F.col("block").alias("b_block")))
           .join(taken, F.col("b_key").eqNullSafe(F.col("key")), "left"))
    more = F.when(F.col("key").isNotNull() & (F.col("last").isNull() | (F.col("_h") <= F.col("last"))), 1).otherwise(0)
    return (out.withColumn("copies", (F.col("epochs") + more).cast("int")).filter("copies > 0")
            .select("row", "_source", "block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))
            .select("row.*", "epoch", number(seed, name, F.col("epoch").cast("long"), F.col("block")).alias("block_order")))


def mixture_report(docs: DataFrame) -> DataFrame:
    """The mixture's rows: doc_id, source, epoch, block_order."""
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "source", "epoch", "block_order")


ORACLE = r"""
WITH RECURSIVE
d AS (SELECT doc_id, source, coalesce(text, '') AS text,
             greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) AS cost,
             CAST('0x' || substr(md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(cost) AS BIGINT) AS n FROM d GROUP BY source),
g AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS k FROM s),
p AS (SELECT source, n, n / CAST(total AS DOUBLE) AS share FROM s, g),
h(step, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END
  FROM (SELECT step, low, high, mid, (SELECT ln(sum(pow(share, mid))) - sum(pow(share, mid) * mid * ln(share)) / sum(pow(share, mid)) FROM p)
               >= CAST(0.95 AS DOUBLE) * ln((SELECT k FROM g)) AS ok
        FROM (SELECT step, low, high, CASE WHEN step = 0 THEN 1 ELSE (low + high) / 2 END AS mid FROM h WHERE step < 61) a) b),
a AS (SELECT CASE WHEN (SELECT k FROM g) < 2 THEN 1 ELSE low END AS alpha FROM h WHERE step = 61),
q AS (SELECT source, n, CAST(floor(pow(share, alpha) / (SELECT sum(pow(share, alpha)) FROM p, a) * total + 0.5) AS BIGINT) AS tokens FROM p, a, g),
pl AS (SELECT source, CAST(ceil(n / 262144.0) AS BIGINT) AS n_blocks, tokens // n AS epochs, tokens % n AS rest FROM q),
x AS (SELECT d.*, epochs, rest, CAST('0x' || substr(md5('1|block|' || CAST(h AS VARCHAR)), 1, 15) AS BIGINT) % n_blocks AS block,
             coalesce('=' || d.source, '-') AS name FROM d JOIN pl ON d.source IS NOT DISTINCT FROM pl.source),
b AS (SELECT source, block, rest, sum(cost) AS tokens, CAST('0x' || substr(md5('1|' || name || '|' || epochs || '|' || block), 1, 15) AS BIGINT) AS ord
      FROM x GROUP BY source, block, rest, name, epochs),
bs AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY ord) - tokens AS before FROM b),
xs AS (SELECT x.*, before, before + sum(cost) OVER (PARTITION BY x.source, x.block ORDER BY h) - sum(cost) OVER (PARTITION BY x.source, x.block, h) AS place
       FROM x JOIN bs ON x.source IS NOT DISTINCT FROM bs.source AND x.block = bs.block),
c AS (SELECT doc_id, source, name, block, epochs + CASE WHEN place < rest THEN 1 ELSE 0 END AS copies FROM xs),
o AS (SELECT doc_id, source, name, block, unnest(range(0, CAST(copies AS BIGINT))) AS e FROM c)
SELECT doc_id, source, CAST(e AS INTEGER) AS epoch,
       CAST('0x' || substr(md5('1|' || name || '|' || e || '|' || block), 1, 15) AS BIGINT) AS block_order FROM o
"""
