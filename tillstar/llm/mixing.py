"""Operator 7: mixing sources to target weights by temperature.

The share p of a source among all tokens becomes the weight p ** a / sum(p ** a). The exponent a, from 0 (all
sources alike) to 1 (as they are), is bisected: the smallest for which no source is repeated more than
``max_repeats`` times, or the one whose weights have ``entropy`` (in nats; held to what 0 and 1 give). Each
round tries a grid of exponents in one small aggregate over the sources, which narrows the range 32-fold.

The weights are realised as block permutations under a token budget (by default the smallest at which every
document is used at least once). A source's documents are dealt into blocks by a hash of their id. Its whole
epochs use every block, in an order that a hash of the epoch permutes; the last, partial epoch uses blocks in
its order while the budget lasts, and of the block in which it ends the documents in hash order until it is
spent. So the budget is overrun by less than a document (documents of equal id go together).

Blocks are bounded in number by source and in tokens by the source's size, and only block sums meet in a
window; a hot source's documents never meet in one task. No document moves: rows are joined with the small
plan of blocks.

Tokens are words; null and empty texts have none and are used once an epoch. A null source is a source of its
own. A source without any token is used once. Repeated rows are separate documents. An empty table gives no
rows. Only built-in column functions are used.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

GRID = 33
ROUNDS = 5


class Target(NamedTuple):
    """One of the first two; the budget in tokens, or None for the least that uses every document."""

    max_repeats: float | None = 1.5
    entropy: float | None = None
    budget: int | None = None


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("-"))


def find_exponent(sources: DataFrame, total: int, target: Target) -> float:
    """Bisect the exponent over ``sources`` (tokens, all above 0, of each), by aggregates over a grid."""
    low, high = 0.0, 1.0
    p = F.col("tokens") / F.lit(float(total))
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / (GRID - 1) for k in range(GRID)]
        tried = sources.select(p.alias("p"), F.explode(F.array(*map(F.lit, grid))).alias("a"))
        sums = tried.groupBy("a").agg(
            F.sum(F.pow("p", "a")).alias("z"), F.sum(F.pow("p", "a") * F.log("p")).alias("zl"),
            F.max(F.pow("p", F.col("a") - 1)).alias("most"), F.min(F.pow("p", F.col("a") - 1)).alias("least")).collect()
        met = []
        for r in sums:
            if target.entropy is not None:
                met.append((r["a"], math.log(r["z"]) - r["a"] * r["zl"] / r["z"] <= target.entropy))
            elif target.budget is None:
                met.append((r["a"], r["most"] / r["least"] <= target.max_repeats))
            else:
                met.append((r["a"], r["most"] / r["z"] * target.budget / total <= target.max_repeats))
        reached = [a for a, ok in met if ok]
        if not reached:
            return high  # as far as 1 goes
        at = min(reached)
        before = [a for a, _ in met if a < at]
        if not before:
            return at
        low, high = max(before), at
    return high


def plan(sizes: DataFrame, target: Target, seed: int, block_tokens: int, max_blocks: int) -> DataFrame:
    """What is used of each block: source, block, n_blocks, epochs (whole), part (blocks of the partial epoch:
    1 whole, 0 cut at hash ``cut``, null not used). ``sizes`` has source, hash and tokens of each document."""
    sources = stored(sizes.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mixing-sources")
    some = sources.where("tokens > 0")
    total = some.agg(F.sum("tokens")).first()[0] or 0
    a = find_exponent(some, total, target) if total else 1.0
    p = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.pow(p, F.lit(a))
    sums = some.agg(F.sum(weight).alias("z"), F.max(F.col("tokens") / weight).alias("cover")).first()
    scale = float(sums["cover"] or 1.0) if target.budget is None else target.budget / float(sums["z"] or 1.0)
    share = F.when(F.col("tokens") > 0, weight * F.lit(scale)).otherwise(0.0)  # the source's budget in tokens
    # Rounding must not take a token off a source that is to be used exactly whole times.
    epochs = F.when(F.col("tokens") > 0, F.floor(share / F.col("tokens") + 1e-9)).otherwise(1).cast("int")
    n_blocks = F.least(F.lit(max_blocks), F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(float(block_tokens))))).cast("int")
    budgets = sources.select("source", epochs.alias("epochs"), n_blocks.alias("n_blocks"),
                             F.greatest(F.lit(0.0), share - epochs * F.col("tokens") - 1e-6 * F.col("tokens")).alias("rest"))
    placed = sizes.join(budgets, "source").select("source", "hash", "tokens", "epochs", "n_blocks", "rest",
                                                  F.pmod("hash", "n_blocks").cast("int").alias("block"))
    blocks = placed.groupBy("source", "epochs", "n_blocks", "rest", "block").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy("source").orderBy(block_rank(F.lit(seed), F.col("epochs"), F.col("source"), F.col("block")), "block")
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = stored(blocks.withColumn("left", F.col("rest") - before).select(
        "source", "block", "n_blocks", "epochs", "left",
        F.when(F.col("left") >= F.col("tokens"), 1).when(F.col("left") > 0, 0).alias("part")), "mixing-blocks")
    # The one block of each source in which the budget ends.
    ends = used.where("part = 0").select("source", "block", "left")
    within = Window.partitionBy("source").orderBy("hash")
    edge = placed.select("source", "block", "hash", "tokens").join(ends, ["source", "block"])
    spent = F.sum("tokens").over(within.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum("tokens").over(within.rangeBetween(0, 0))
    cuts = edge.withColumn("spent", spent).where("spent < left").groupBy("source").agg(F.max("hash").alias("cut"))
    return used.join(cuts, "source", "left").select("source", "block", "n_blocks", "epochs", "part", "cut")


def block_rank(seed: Column, epoch: Column, source: Column, block: Column) -> Column:
    return F.xxhash64(seed, epoch, source, block)


def mix(df: DataFrame, target: Target = Target(), text_col: str = "text", source_col: str = "source",
        id_col: str = "doc_id", seed: int = 7, block_tokens: int = 1_000_000, max_blocks: int = 10_000) -> DataFrame:
    """The mixture: ``df``'s rows as often as the weights ask, with ``mix``, a struct of epoch (from 0), block and
    rank. Sorting by epoch and rank, and within them by any shuffle, gives the order of the block permutations."""
    taken = {c for c in df.columns if c == "mix" or c.startswith("__")}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are used by the mixture")
    hashed = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
    sizes = stored(df.select(source_key(F.col(source_col)).alias("source"), hashed.alias("hash"),
                             token_count(F.col(text_col)).alias("tokens")), "mixing-sizes")
    counts = stored(plan(sizes, target, seed, block_tokens, max_blocks), "mixing-plan")
    per_source = counts.select("source", "n_blocks").distinct()
    rows = df.withColumns({"__source": source_key(F.col(source_col)), "__hash": hashed})
    rows = rows.join(per_source.select(F.col("source").alias("__s"), F.col("n_blocks").alias("__n")), F.col("__source") == F.col("__s"))
    rows = rows.withColumn("__block", F.pmod("__hash", "__n").cast("int"))
    chosen = counts.select(F.col("source").alias("__s2"), F.col("block").alias("__b2"), F.col("epochs").alias("__epochs"),
                           F.col("part").alias("__part"), F.col("cut").alias("__cut"))
    rows = rows.join(chosen, (F.col("__source") == F.col("__s2")) & (F.col("__block") == F.col("__b2")))
    extra = F.when((F.col("__part") == 1) | ((F.col("__part") == 0) & (F.col("__hash") <= F.col("__cut"))), 1).otherwise(0)
    times = F.col("__epochs") + extra
    rows = rows.where(times > 0).withColumn("__epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    rank = block_rank(F.lit(seed), F.col("__epoch"), F.col("__source"), F.col("__block"))
    return rows.select(*(F.col(f"`{c}`") for c in df.columns),
                       F.struct(F.col("__epoch").alias("epoch"), F.col("__block").alias("block"), rank.alias("rank")).alias("mix"))
