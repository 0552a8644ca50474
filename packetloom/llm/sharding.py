"""K-d tree sharding by size.

Documents are points in a space of metadata (source, language, length); equal texts are one point, placed by the smallest
source and language among them. A node of the tree is split along the dimension in which its points are spread the widest,
at the weighted median (the weight is bytes), until a leaf holds its share: the target bytes are all bytes over the number of shards.

Medians are found without gathering points: a point's key is its coordinate in 20 bits and then 20 bits of a hash of the text, and
three histograms, each over the bin that the one before it chose, lead to the key at which the weights part best. All nodes of a level
share the three passes, and the driver sees at most 2**14 bins per node.

A group of equal texts stays in one shard unless it outweighs `split_share` of a shard; then it is cut into small
points by id, as no shard could hold it and stay near its size. A source of any size is split like anything else.

Defined cases: a NULL text has size 1; NULL metadata is the empty word; repeated rows get slots of their own; an empty table gives
no rows. The law is `bytes`: sizes near equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import same, staged, sums_before

SHARDS = 16
SPLIT_SHARE = 0.1
SLOT_BUCKET = 4096
_ROUNDS = ((26, 14), (13, 13), (0, 13))  # (bits below, bits of the bin) of a 40-bit key


def _position(word: Column) -> Column:
    """A word's place in [0, 1), spread evenly."""
    return F.pmod(F.xxhash64(F.coalesce(word, F.lit(""))), F.lit(1 << 20)) / float(1 << 20)


def _cut(bins: list[tuple[int, int]], goal: float, before: int) -> tuple[int, int, int]:
    """The bin in which the running weight passes `goal`, the weight before it, and whether the cut is nearer to its end."""
    run = before
    for bin_, weight in sorted(bins):
        if run + weight >= goal:
            return bin_, run, int(goal - run > run + weight - goal)
        run += weight
    return max(b for b, _ in bins), run, 1


def split_points(points: DataFrame, shards: int) -> DataFrame:
    """`points` (weight, hash and the coordinates d0, d1, ...) with their `shard`."""
    dims = [c for c in points.columns if c.startswith("d")]
    whole = points.agg(*[f(d) for d in dims for f in (F.min, F.max)]).first()
    scale = {d: (whole[2 * i + 1] or 0) - (whole[2 * i] or 0) or 1.0 for i, d in enumerate(dims)}
    nodes = {0: (0, shards)}  # node: its first shard and the one after its last
    placed = points.withColumn("node", F.lit(0))
    while any(hi - lo > 1 for lo, hi in nodes.values()):
        spread = placed.groupBy("node").agg(F.sum("weight"), *[f(d) for d in dims for f in (F.min, F.max)]).collect()
        key = F.lit(0).cast("long")
        goals = {}
        for row in spread:
            lo, hi = nodes[row[0]]
            if hi - lo == 1:
                continue
            wide = [(row[3 + 2 * i] - row[2 + 2 * i]) / scale[d] for i, d in enumerate(dims)]
            best = wide.index(max(wide))
            low, span = row[2 + 2 * best], (row[3 + 2 * best] - row[2 + 2 * best]) or 1.0
            at = F.floor((F.col(dims[best]) - low) / span * ((1 << 20) - 1)) * (1 << 20) + F.col("hash")
            key = F.when(F.col("node") == row[0], at).otherwise(key)
            goals[row[0]] = row[1] * ((hi - lo) // 2) / (hi - lo)
        # Nodes without points, as small or empty tables have them, are done.
        nodes = {n: span for n, span in nodes.items() if n in goals or span[1] - span[0] == 1}
        if not goals:
            break
        keyed = placed.withColumn("key", key)
        found = {n: (0, 0) for n in goals}  # node: the key's leading bits so far, weight below
        for below, bits in _ROUNDS:
            inside = F.lit(False)
            for n, (lead, _) in found.items():
                inside = inside | ((F.col("node") == n) & (F.shiftright("key", below + bits) == lead))
            histogram: dict[int, list] = {n: [] for n in goals}
            bins = keyed.filter(inside).groupBy("node", F.shiftright("key", below).alias("bin")).agg(F.sum("weight"))
            for n, bin_, weight in bins.collect():  # at most 2 ** bits rows per node
                histogram[n].append((bin_, weight))
            ends = {n: _cut(histogram[n], goals[n], found[n][1]) for n in goals}
            found = {n: (bin_, run) for n, (bin_, run, _) in ends.items()}
        child = F.col("node") * 2 + 1
        for n in goals:
            child = F.when((F.col("node") == n) & (F.col("key") >= ends[n][0] + ends[n][2]), F.col("node") * 2 + 2).otherwise(child)
        still = F.col("node").isin(list(goals))
        placed = staged(keyed.withColumn("node", F.when(still, child).otherwise(F.col("node"))).drop("key"), "kd-points")
        for n in goals:
            lo, hi = nodes.pop(n)
            nodes[2 * n + 1], nodes[2 * n + 2] = (lo, lo + (hi - lo) // 2), (lo + (hi - lo) // 2, hi)
    shard = F.lit(None).cast("int")
    for n, (lo, _) in nodes.items():
        shard = F.when(F.col("node") == n, F.lit(lo)).otherwise(shard)
    return placed.withColumn("shard", shard)


def shard_documents(docs: DataFrame, shards: int = SHARDS, split_share: float = SPLIT_SHARE) -> DataFrame:
    """`doc_id, size, text_crc32, law, shard, slot, grown_shard` for every row of `docs` (doc_id, text, lang, source)."""
    text = F.coalesce("text", F.lit(""))
    rows = staged(
        docs.select(
            "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
        ),
        "shard-rows",
    )
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    target = max(1.0, (total or 0) / shards)
    equal = ["text_hash", "text_crc32", "size"]
    # At most shards / split_share groups weigh as much, whatever the table's size.
    heavy = rows.groupBy(*equal).agg(F.sum("size").alias("weight")).filter(F.col("weight") > split_share * target)
    parts = heavy.select(*equal, F.ceil(F.col("weight") / F.lit(target * split_share / 10)).alias("parts"))
    split = rows.join(F.broadcast(parts), equal, "left").withColumn(
        "part", F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    )
    split = staged(split.drop("parts"), "shard-rows-split")
    low = F.pmod(F.xxhash64("text_hash", "part"), F.lit(1 << 20))
    points = split.groupBy(*equal, "part").agg(
        F.sum("size").alias("weight"), F.min("source").alias("source"), F.min("lang").alias("lang")
    ).select(
        *equal, "part", "weight", low.alias("hash"), _position(F.col("source")).alias("d0"), _position(F.col("lang")).alias("d1"),
        F.log2(F.col("size").cast("double")).alias("d2"),
    )
    placed = split_points(staged(points, "shard-points"), shards)
    chosen = split.join(placed.select(*equal, "part", "shard"), [*equal, "part"])
    buckets = max(1, math.ceil(n_rows / shards / SLOT_BUCKET))
    bucketed = staged(
        chosen.select("doc_id", "size", "text_crc32", "text_hash", "shard")
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets))),
        "shard-buckets",
    )
    starts = sums_before(bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n")), ["shard"], "bucket", "n", "start")
    inner = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_hash"))
    numbered = bucketed.withColumn("inner", inner)
    joined = numbered.join(starts, same(numbered, starts, "shard", "bucket"))
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), numbered["shard"],
        (F.col("start") + F.col("inner") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
