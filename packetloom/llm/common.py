"""What several of these operators need: words by Spark functions, row keys, tables between steps, linked components."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.sources.stage import write_stage

#: Characters between words once A-Z are lower case (fixed by the contracts).
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; NULL becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text, in order, as an array: maximal runs of a-z, 0-9 and everything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), WORD_BREAK), "")


def row_key(*cols: str) -> Column:
    """Tells rows apart by what they hold. Rows that agree in all of `cols` share a key and, with it, their result."""
    return F.struct(*[F.col(c) for c in cols])


def same(left: DataFrame, right: DataFrame, *cols: str) -> Column:
    """Equal in `cols`, NULL with NULL."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back, so a lost executor costs no earlier work."""
    return write_stage(df, name)


def over_texts(
    df: DataFrame, schema: str, rows: Callable[..., dict[str, object]], keep: list[str], text: str = "text", also: list[str] | None = None,
    chars: int = 2_000_000,
) -> DataFrame:
    """Columns made from the texts of `df` (and its columns `also`) by `rows`, which takes lists and gives lists or arrays by name, beside
    the columns `keep` as they are.

    Works on pieces of an Arrow batch of about `chars` bytes, a longer text alone, so memory follows the longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            piece = np.cumsum(sizes) // chars
            edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
            for lo, hi in zip(edges, edges[1:]):
                part = batch.slice(lo, hi - lo)
                made = rows(*(part.column(c).to_pylist() for c in [text, *(also or [])]))
                cols = [part.column(c) for c in keep] + list(made.values())
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], [*keep, *made])

    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    needed = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, text, *(also or [])])]
    return df.select(*needed).mapInArrow(run, ", ".join([*kept, schema]))


def hashed_share(rows: DataFrame, most: int, *cols: str) -> DataFrame:
    """About `most` of `rows` (all, if they are no more), chosen by a hash of `cols`: unlike a sorted limit, no task sends more than its
    share of them, and at least one row is chosen. Rows that agree in `cols` are chosen together, so these should tell rows apart."""
    h = F.pmod(F.xxhash64(*cols), F.lit(1 << 30))
    total, least = rows.agg(F.count("*"), F.min(h)).first()
    if total <= most:
        return rows
    return rows.filter((h < int(most / total * (1 << 30))) | (h == least))


#: Up to so many rows one task can take whatever their keys are.
ONE_TASK = 1_000_000


def join_spread(rows: DataFrame, table: DataFrame, keys: list[str], total: int, share: int = 1000, one_task: int = ONE_TASK) -> DataFrame:
    """`rows` joined with `table`, which has one row per key and, in `n`, about how many of the `total` rows have it.

    Keys with over a `share`-th of the rows (at most `share` of them) are broadcast, so their rows stay where they are; the others are
    joined by shuffle, in which no key is large. Where no more than `one_task` rows are joined, no key can be too large. Otherwise `rows` and
    `table` are written first, as both are read twice.
    """
    if total <= one_task:
        return rows.join(table, keys)
    rows, table = staged(rows, "spread-rows"), staged(table, "spread-keys")
    is_hot = F.col("n") * share > total
    hot = F.broadcast(table.filter(is_hot))
    others = rows.join(F.broadcast(table.filter(is_hot).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(others.join(table.filter(~is_hot), keys))


def dealt(pairs: DataFrame, count: int, *keys: str) -> DataFrame:
    """`pairs` (`count` rows of much work and few bytes) dealt to tasks by `keys`: to every core, and no more than 32 to a task."""
    cores = pairs.sparkSession.sparkContext.defaultParallelism
    return pairs.repartition(max(1, min(count, cores), -(-count // 32)), *keys)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Rows `node, root` for all nodes of `edges` (a, b): root is the smallest node reachable.

    Alternating stars: every node hands its larger, then its smaller neighbours to the smallest one it knows, until
    nothing changes. A round is two joins on whole numbers; the number of rounds grows with the logarithm of the longest path.
    Nothing but a count and a checksum reaches the driver, and each round is a written table.
    """
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    links = staged(links, name)
    mark = None
    while True:
        now = tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == mark or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        met = join_spread(both, low, ["a"], 2 * now[0])
        large = staged(met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        met = join_spread(large, low, ["a"], 2 * now[0])
        small = met.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = staged(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)


def local_forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 linked by pairs (a, b): the smallest node of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:  # follow labels to their ends
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
        if np.array_equal(before, label):
            break
    return label


def sums_before(df: DataFrame, keys: list[str], order: str, value: str, into: str, step: int = 4096) -> DataFrame:
    """`df` with, per row, the sum of `value` over the rows of the same `keys` with a smaller whole number `order`.

    Two levels, so that no window holds more than `step` rows of a key, nor more than one row per `step` numbers.
    """
    from pyspark.sql import Window

    group = F.floor(F.col(order) / step)
    totals = df.groupBy(*keys, group.alias("_g")).agg(F.sum(value).alias("_v"))
    upper = Window.partitionBy(*keys).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_g", F.coalesce(F.sum("_v").over(upper), F.lit(0)).alias("_c"))
    lower = Window.partitionBy(*keys, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_g", group).withColumn("_i", F.coalesce(F.sum(value).over(lower), F.lit(0)))
    joined = inner.join(carried, same(inner, carried, *keys, "_g"), "left")
    return joined.select(*[inner[c] for c in df.columns], (F.col("_i") + F.col("_c")).alias(into))
