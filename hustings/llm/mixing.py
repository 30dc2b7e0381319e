"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets. Sources in code-point order (NULL last) weigh 5, 2, 1, 5, 2, 1, ... and
share ``SHARE`` of all words by weight; a target stops at ``CEILING`` times its
source's words, and the excess goes to the others by weight until none is above.
Sources are ranked by a range partitioning; each round of resharing is one
aggregation over the table of sources.

Blocks. The documents of a source are dealt by hash into blocks of about
``BLOCK_WORDS`` words, so that a hot source has many blocks and no task holds it.
Blocks of a source are permuted by hash. A source draws whole blocks in that
order until its target is met, after a first draw of all blocks when the target
is above its words; of the block in which the target falls, single documents are
picked in permuted order as long as they fit, then one more if it brings the sum
nearer. No document is drawn more than twice.

Shards. The numbers of blocks each source draws (its quota) are split among output
shards by a binary tree: a node's left child gets a multivariate-hypergeometric
sample of the node's quotas, of the size of its share of shards. So every shard has
an exact quota of every source, its blocks are a stretch of the source's permuted
draws, disjoint from all others', and it is shuffled by itself. A tree task sees one
number per source, ``TREE_DEPTH`` levels at a time.

All draws are seeded by hashes and node numbers, so reruns agree, whatever the
number of tasks. Rows that are equal in id, source and text are numbered, and each
copy is dealt and drawn by itself.

Cases: a null text has no words; documents without words go with their block and
take 0 words. A null source is a source of its own; null ids hash like any value. A
table without words has targets 0 and takes nothing. An empty table gives no rows.
Extra columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, number_copies, running, ship

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2
BLOCK_WORDS = 1 << 16
SHARD_WORDS = 1 << 22
TREE_DEPTH = 10
SEED = 20


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def key_of(doc_id: Column, text: Column) -> Column:
    """Equal for rows of equal id and text."""
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")), text.isNull())


def keyed(rows: DataFrame) -> DataFrame:
    """Rows (source, key) with a key of its own for each copy of equal rows."""
    copy = free_name(rows, "copy")
    own = F.when(F.col(copy) == 0, F.col("key")).otherwise(F.xxhash64("key", copy))
    return number_copies(rows, ["source", "key"], copy).withColumn("key", own).drop(copy)


def targets(sized: DataFrame) -> DataFrame:
    """(source, rank, source_size, n_docs, target) of every source of (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    last = free_name(sums, "last")
    ranked = running(sums.withColumn(last, F.col("source").isNull()), [last, "source"], {}, rank="rank").drop(last)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    weighed = materialize(ranked.withColumn("weight", weight), "sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words for a weight of 1, for sources below their ceiling
    while total:
        above = F.col("source_size") * CEILING < F.lit(level) * F.col("weight")
        full, rest = weighed.agg(
            F.sum(F.when(above, F.col("source_size") * CEILING).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        new = (SHARE * total - full) / rest
        if new <= level:
            break
        level = new
    ceiling = (F.col("source_size") * CEILING).cast("double")
    return weighed.withColumn("target", F.least(ceiling, F.lit(level) * F.col("weight"))).drop("weight")


def _in_blocks(rows: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """Rows (source, key) with the rank of the source and the block of the row."""
    blocks = F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("n_docs")) / block_words))
    known = sources.select(F.col("source").alias("_source"), "rank", "source_size", "target", blocks.alias("n_blocks"))
    return (
        rows.join(known, rows["source"].eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("block", F.pmod(F.xxhash64("key", F.lit(SEED)), F.col("n_blocks")))
    )


def _pick(docs: pd.DataFrame) -> pd.DataFrame:
    """Of the documents of one block, those whose words come nearest to what is left."""
    docs = docs.groupby("key", as_index=False).agg({"size": "sum", "order": "first", "rank": "first", "left": "first"})
    docs = docs.sort_values(["order", "key"])
    left, taken, passed = float(docs["left"].iloc[0]), [], []
    for key, size in zip(docs["key"], docs["size"], strict=True):
        if size <= left:
            taken.append(key)
            left -= size
        else:
            passed.append((size, key))
    if passed and min(passed)[0] - left < left:
        taken.append(min(passed)[1])
    return pd.DataFrame({"rank": docs["rank"].iloc[0], "key": taken}).astype("int64")


def _split():
    """Quotas of a node for its descendants ``TREE_DEPTH`` levels below, or its shards."""

    def split(node: pd.DataFrame) -> pd.DataFrame:
        node = node.sort_values("rank")
        low, high = int(node["low"].iloc[0]), int(node["high"].iloc[0])
        done = []

        def walk(low: int, high: int, quota: np.ndarray, depth: int) -> None:
            if high - low == 1 or depth == TREE_DEPTH:
                done.append((low, high, quota))
                return
            middle = (low + high) // 2
            half = int(quota.sum()) * (middle - low) // (high - low)
            rng = np.random.default_rng([SEED, low, high])
            left = rng.multivariate_hypergeometric(quota, half, method="marginals")
            walk(low, middle, left, depth + 1)
            walk(middle, high, quota - left, depth + 1)

        walk(low, high, node["quota"].to_numpy(dtype=np.int64), 0)
        out = [pd.DataFrame({"low": a, "high": b, "rank": node["rank"], "quota": q})[q > 0] for a, b, q in done]
        return pd.concat(out).astype("int64")

    return split


def shard_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """(shard, rank, quota) from (rank, quota): blocks of each source for each shard."""
    nodes = quotas.where("quota > 0").select(F.lit(0).cast("bigint").alias("low"), F.lit(shards).cast("bigint").alias("high"), "rank", "quota")
    for _ in range(math.ceil(math.log2(max(2, shards)) / TREE_DEPTH)):
        nodes = nodes.groupBy("low", "high").applyInPandas(_split(), "low bigint, high bigint, rank bigint, quota bigint")
    return materialize(nodes.select(F.col("low").alias("shard"), "rank", "quota"), "quotas")


class Mix:
    """The mix of a table of documents: targets, draws and shards."""

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS):
        source = F.col("source").cast("string").alias("source")
        text = F.col("text").cast("string")
        # Texts are read once; all that follows works on this narrow table.
        ship(docs.sparkSession)
        sized = materialize(docs.select("doc_id", source, key_of(F.col("doc_id"), text).alias("key"), size_of(text).alias("size")), "sized")
        self.sized = materialize(keyed(sized), "keyed")
        self.block_words = block_words
        self.sources = materialize(targets(self.sized), "targets")
        rows = _in_blocks(self.sized, self.sources, block_words)
        blocks = rows.groupBy("rank", "block").agg(
            F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
        )
        order = F.xxhash64("rank", "block", F.lit(SEED))
        placed = materialize(running(blocks.withColumn("order", order), ["rank", "order", "block"], {"before": "words"}, rank="place"), "placed")
        starts = placed.groupBy("rank").agg(
            F.min("place").alias("first_place"), F.min("before").alias("first_word"), F.count(F.lit(1)).alias("held")
        )
        twice = F.col("target") > F.col("source_size")
        left = F.col("target") - F.when(twice, F.col("source_size")).otherwise(0) - (F.col("before") - F.col("first_word"))
        draws = (
            placed.join(starts, "rank")
            .withColumns({"first": F.when(twice, 1).otherwise(0), "left": left})
            .withColumns(
                {
                    "place": F.col("place") - F.col("first_place"),
                    "whole": F.when((F.col("words") <= F.col("left")), 1).otherwise(0),
                    "part": (F.col("left") > 0) & (F.col("words") > F.col("left")),
                }
            )
        )
        self.draws = materialize(draws.select("rank", "block", "place", "held", "first", "whole", "part", "left"), "draws")
        quotas = self.draws.groupBy("rank").agg(F.sum(F.col("first") + F.col("whole") + F.col("part").cast("int")).alias("quota"))
        words = self.sources.agg(F.sum("target")).first()[0] or 0
        self.shards = max(1, math.ceil(words / shard_words))
        self.quotas = shard_quotas(quotas, self.shards)
        parts = self.draws.where("part").select("rank", "block", "left")
        self.picks = materialize(
            _in_blocks(self.sized, self.sources, block_words)
            .join(parts, ["rank", "block"])
            .select("rank", "key", "size", F.xxhash64("key", F.lit(SEED + 1)).alias("order"), "left")
            .groupBy("rank")
            .applyInPandas(_pick, "rank bigint, key bigint"),
            "picks",
        )
        self.block_shards = materialize(self._block_shards(), "block-shards")

    def _block_shards(self) -> DataFrame:
        """(rank, block, first, whole, part, shards): the shards of a block's draws, in the order of the draws."""
        stretches = running(self.quotas, ["rank", "shard"], {"begin": "quota"})
        owners = stretches.select(
            "shard", F.explode(F.sequence("begin", F.col("begin") + F.col("quota") - 1)).alias("at")
        )
        begins = stretches.groupBy("rank").agg(F.min("begin").alias("begin"))
        again = F.when((F.col("whole") == 1) | F.col("part"), F.col("place") + F.col("first") * F.col("held"))
        at = F.array(F.when(F.col("first") == 1, F.col("place")), again)
        drawn = (
            self.draws.select("rank", "block", F.posexplode(at).alias("turn", "at"))
            .where("at is not null")
            .join(begins, "rank")
            .select("rank", "block", "turn", (F.col("at") + F.col("begin")).alias("at"))
            .join(owners, "at")
            .groupBy("rank", "block")
            .agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
        )
        return self.draws.join(drawn, ["rank", "block"], "left").select(
            "rank", "block", "first", "whole", "part", F.coalesce(F.col("turns.shard"), F.array().cast("array<bigint>")).alias("shards")
        )

    def drawn(self, rows: DataFrame) -> DataFrame:
        """Rows (with source and key) with ``source_size``, ``target`` and ``shards``, one for each copy taken."""
        picked = self.picks.withColumn("picked", F.lit(True))
        out = (
            _in_blocks(rows, self.sources, self.block_words)
            .join(self.block_shards, ["rank", "block"])
            .join(picked, ["rank", "key"], "left")
        )
        copies = F.col("first") + F.when(F.col("part"), F.when(F.col("picked"), 1).otherwise(0)).otherwise(F.col("whole"))
        return out.withColumn("shards", F.slice("shards", F.lit(1), copies)).drop(
            "rank", "block", "n_blocks", "first", "whole", "part", "picked"
        )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``docs`` with every copy taken as a row, shard by shard, shuffled within shards."""
    mix = Mix(docs, **options)
    row = free_name(docs, "whole_row")
    text = F.col("text").cast("string")
    packed = docs.select(
        F.col("source").cast("string").alias("source"),
        key_of(F.col("doc_id"), text).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row),
    )
    taken = mix.drawn(keyed(packed)).select(row, "key", F.posexplode("shards").alias("turn", "shard"))
    order = F.xxhash64("key", "turn", "shard", F.lit(SEED))
    return taken.withColumn("order", order).repartition("shard").sortWithinPartitions("shard", "order", "key").select(f"{row}.*")


def digest(docs: DataFrame) -> DataFrame:
    """Every document with its size, its source's words and target, the words taken and the shards of its copies."""
    mix = Mix(docs.select("doc_id", "source", "text"))
    return mix.drawn(mix.sized).select(
        "doc_id", "size", "source_size", "target", (F.size("shards") * F.col("size")).cast("bigint").alias("taken"), "shards"
    )
