"""Times that keep a distance: the first of a key, then each first one more than a gap after the one before.

The lives of users and the sweeps of a collector are such chains. Each time depends on the one before, so a chain is a fold over sorted
times; for keys with many times it is found by jumps of doubling length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.operators.joins import broadcast_if_small
from packetloom.operators.ordered import before, find_hot_keys
from packetloom.sources.stage import write_stage

#: Times of a key that one fold takes.
TIMES_LIMIT = 200_000


def hot_times(timed: DataFrame, keys: list[str], limit: int | None = TIMES_LIMIT) -> DataFrame | None:
    """Keys of `timed` (keys, t) with many rows. A mark (`tie` 0) comes before the rows of its moment (`tie` 1)."""
    return find_hot_keys(timed.select(*keys, "t", F.lit(1).alias("tie")), keys, ["t", "tie"], limit)


def times_apart(timed: DataFrame, keys: list[str], gap: int, hot: DataFrame | None) -> DataFrame:
    """`keys, t`: the chain of every key of `timed`, where `t` and `gap` have the same unit."""
    times = timed.select(*keys, "t").distinct()
    if hot is None:
        return _folded(times, keys, gap)
    busy_keys = broadcast_if_small(hot.select(*keys))
    calm = times.join(busy_keys, keys, "left_anti")
    busy = times.join(busy_keys, keys, "left_semi")
    return _folded(calm, keys, gap).unionByName(_jumped(busy, keys, gap, hot))


def _folded(times: DataFrame, keys: list[str], gap: int) -> DataFrame:
    def step(chain, t):
        return F.when((F.size(chain) == 0) | (t > F.try_element_at(chain, F.lit(-1)) + gap), F.array_append(chain, t)).otherwise(chain)

    listed = times.groupBy(*keys).agg(F.array_sort(F.collect_list("t")).alias("times"))
    chain = F.aggregate("times", F.array().cast("array<bigint>"), step)
    return listed.select(*keys, F.explode(chain).alias("t"))


def _jumped(times: DataFrame, keys: list[str], gap: int, hot: DataFrame) -> DataFrame:
    """`next(t)` is the first time after t + gap. The chain is what repeated `next` reaches from the first time; a round doubles the
    length of the jumps, so a year of one-hour gaps takes fourteen rounds of equi-joins on (key, time), which is unique and
    therefore never skewed."""
    # Look ahead by running time backwards: the first later time is the latest earlier one of negated times.
    ends = times.select(*keys, (-F.col("t") - gap).alias("at"), F.col("t").alias("start"))
    points = times.select(*keys, (-F.col("t")).alias("at"), (-F.col("t")).alias("mark"))
    both = points.unionByName(ends, allowMissingColumns=True).withColumn("tie", F.col("start").isNull().cast("int"))
    # Times are distinct here, so no position is crowded.
    mirrored = hot.select(*keys, F.sort_array(F.transform("bounds", lambda b: -b)).alias("bounds"))
    jumps = before(both, keys, ["at", "tie"], last={"found": F.col("mark")}, hot=mirrored)
    jumps = jumps.filter("start IS NOT NULL AND found IS NOT NULL").select(*keys, F.col("start").alias("t"), (-F.col("found")).alias("to"))
    jumps = write_stage(jumps, "time-jumps")
    chain = write_stage(times.groupBy(*keys).agg(F.min("t").alias("t")), "time-chain")
    reached, n = chain.count(), 0
    while reached != n:
        n = reached
        landed = chain.join(jumps, [*keys, "t"]).select(*keys, F.col("to").alias("t"))
        chain = write_stage(chain.unionByName(landed).distinct(), "time-chain")
        reached = chain.count()
        onward = jumps.select(*keys, F.col("t").alias("to"), F.col("to").alias("further"))
        jumps = write_stage(jumps.join(onward, [*keys, "to"]).select(*keys, "t", F.col("further").alias("to")), "time-jumps")
    return chain
