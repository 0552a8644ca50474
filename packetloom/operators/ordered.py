"""What was the latest value before this row? The one ordered primitive of the library.

Sequence checks, open/close stitching, dictionary lookups and counter deltas all ask for the latest value
among the earlier rows of the same key. A plain window answers it, as long as no key holds so many rows
that its window partition overloads one task. `find_hot_keys` finds such keys, and `before` cuts
their rows into slices of bounded size, solves every slice on its own and carries the state at the end of
each slice into the following ones. The result is the same row for row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetloom.operators.joins import broadcast_if_small
from packetloom.sources.stage import write_stage

GROUP_LIMIT = 4_000_000
#: Rows that one task orders in memory. Merged partitions of Spark's own choice go by compressed bytes, several times that many rows, and spill.
TASK_ROWS = 250_000
#: Buckets of the first count hold this share of `group_limit` on average, so a full one tells of a hot key at any size.
_BUCKET_SHARE = 1 / 64
#: Cuts of a key that one pass of quantiles gives; between them, finer cuts are counted off.
_COARSE_CUTS = 1000
#: Steps of a search by halving, from the largest down; they reach any place of an array.
_HALVING = [2**i for i in range(30, -1, -1)]


def limit_for(group_limit: int | None, *tables: DataFrame) -> int | None:
    """None when the tables together have no more rows than `group_limit`: then no key can have more either, and
    nothing needs to be searched. Counting a written table reads no column."""
    if group_limit is None or sum(t.count() for t in tables) <= group_limit:
        return None
    return group_limit


def rows_of(df: DataFrame, group_limit: int | None) -> int | None:
    """Rows of `df`, counted only where hot keys are searched for: otherwise they are few."""
    return None if group_limit is None else df.count()


def _dealt(df: DataFrame, by: list[str], rows: int | None) -> DataFrame:
    """`df` dealt by `by` to as many tasks as its `rows` ask for; few rows are left to Spark."""
    tasks = math.ceil((rows or 0) / TASK_ROWS)
    return df if tasks <= df.sparkSession.sparkContext.defaultParallelism else df.repartition(tasks, *by)


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    group_limit: int | None = GROUP_LIMIT,
    total: int | None = None,
) -> DataFrame | None:
    """Keys with more than `group_limit` rows and, per key, ascending `bounds` that cut its rows into even slices.

    None when there are no such keys, which is the usual case and costs one job: rows are counted per hash
    bucket, fully combined before the shuffle, and no key can have more rows than its bucket. The number of buckets
    follows the number of rows. Only when a bucket is too full are its keys counted one by one. All of it stays in
    written tables; what is broadcast is measured first.

    Positions (values of the first column of `order`) that alone hold more rows than the limit are `crowded`: they have bounds over the second
    column of `order`, if there is one, and `ties`, its values that are still too full. Rows of the same whole position know nothing of
    each other, so they are dealt into `parts` by a hash. `order` has to be the whole order of the rows. `total` is the number of rows, if it
    is known.
    """
    if group_limit is None:
        return None
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    buckets = max(64, math.ceil((df.count() if total is None else total) / (group_limit * _BUCKET_SHARE)))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    full = df.groupBy(bucket.alias("bucket")).count().filter(F.col("count") > group_limit).select("bucket")
    full = write_stage(full, "full-buckets")
    if full.isEmpty():
        return None
    # Several counts follow: they read keys and positions of the full buckets, not what leads to them.
    rows = df.select(*keys, *order).withColumn("bucket", bucket).join(broadcast_if_small(full), "bucket").drop("bucket")
    rows = write_stage(rows, "full-bucket-rows")
    hot_df = write_stage(
        rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > group_limit), "hot-keys"
    )
    if hot_df.isEmpty():
        return None
    busy = rows.join(broadcast_if_small(hot_df.select(*keys)), keys)
    measured = _bounds(busy, hot_df, keys, order[0], group_limit)
    crowded = _crowded(busy, keys, order, group_limit)
    found = measured.join(broadcast_if_small(crowded), keys, "left")
    places = F.coalesce(F.transform("crowded", lambda c: c["at"]), F.array().cast(measured.schema["bounds"].dataType))
    return write_stage(
        found.select(*keys, F.array_sort(F.array_union("bounds", places)).alias("bounds"), "crowded"), "hot-bounds"
    )


def rank(bounds: Column, value: Column, field: str | None = None) -> Column:
    """How many of the ascending `bounds` (or their `field`) are below `value`; halving looks at 31 of them, however many there are."""

    def step(at: Column, ahead: Column) -> Column:
        bound = F.get(bounds, at + ahead - 1)
        return F.when((bound if field is None else bound[field]) < value, at + ahead).otherwise(at)

    return F.aggregate(F.array(*[F.lit(n) for n in _HALVING]), F.lit(0), step)


def _bounds(rows: DataFrame, counts: DataFrame, keys: list[str], order: str, group_limit: int) -> DataFrame:
    """`keys, bounds`: as many cuts per key as its count `n` in `counts` asks for, two to a limit.

    Quantiles give up to `_COARSE_CUTS` of them. If the largest key needs more, the rows between these are numbered, and every
    half limit there is a cut.
    """
    largest = counts.agg(F.max("n")).first()[0]
    wanted = 2 * math.ceil(largest / group_limit)
    pieces = min(wanted, _COARSE_CUTS)
    fractions = [i / pieces for i in range(1, pieces)]
    quantiles = F.percentile_approx(order, fractions, max(10000, 10 * pieces))
    measured = rows.groupBy(*keys).agg(quantiles.alias("bounds")).join(broadcast_if_small(counts), keys)
    step = F.greatest(F.lit(1), F.floor(F.lit(pieces * group_limit / 2) / F.col("n"))).cast("int")
    cuts = measured.select(*keys, F.array_distinct(F.filter("bounds", lambda b, i: (i + 1) % step == 0)).alias("bounds"))
    if wanted == pieces:
        return cuts
    cuts = write_stage(cuts, "coarse-bounds")
    blocks = rows.select(*keys, order).join(broadcast_if_small(cuts), keys).select(
        *keys, order, rank(F.col("bounds"), F.col(order)).alias("block")
    )
    numbered = blocks.withColumn("rn", F.row_number().over(Window.partitionBy(*keys, "block").orderBy(order)))
    fine = numbered.filter(F.col("rn") % max(1, group_limit // 2) == 0).groupBy(*keys).agg(F.collect_set(order).alias("fine"))
    both = cuts.join(fine, keys, "left")
    union = F.array_sort(F.array_union("bounds", F.coalesce("fine", F.array().cast(cuts.schema["bounds"].dataType))))
    return both.select(*keys, union.alias("bounds"))


def _crowded(rows: DataFrame, keys: list[str], order: list[str], group_limit: int) -> DataFrame:
    """`keys, crowded`: per key its positions with more rows than the limit, how they are cut and into how many parts full ties go."""

    def too_full(table: DataFrame, by: list[str], name: str) -> DataFrame:
        counts = table.groupBy(*by).agg(F.count("*").alias("n")).filter(F.col("n") > group_limit)
        return write_stage(counts, name)

    at = [*keys, order[0]]
    places = too_full(rows, at, "crowded")
    parts = F.ceil(F.max("n") / group_limit).cast("int")
    if len(order) == 1:
        cut = places.groupBy(*at).agg(parts.alias("parts"))
        shape = F.struct(F.col(order[0]).alias("at"), "parts")
    else:
        second = order[1]
        kind = rows.schema[second].dataType.simpleString()
        none = F.array().cast(f"array<{kind}>")
        inside = rows.join(broadcast_if_small(places.select(*at)), at)
        tied = too_full(inside, [*at, second], "ties").groupBy(*at).agg(F.array_sort(F.collect_list(second)).alias("ties"), parts.alias("parts"))
        bounds = places.select(*at) if places.isEmpty() else _bounds(inside, places, at, second, group_limit)
        bounds = bounds if "bounds" in bounds.columns else bounds.withColumn("bounds", none)
        cut = bounds.join(tied, at, "left").withColumn("ties", F.coalesce("ties", none))
        shape = F.struct(
            F.col(order[0]).alias("at"), F.array_sort(F.array_union("bounds", "ties")).alias("inner"), "ties",
            F.coalesce("parts", F.lit(1)).alias("parts"),
        )
    return cut.groupBy(*keys).agg(F.array_sort(F.collect_list(shape)).alias("crowded"))


def _slices(df: DataFrame, order: list[str], hot: DataFrame) -> tuple[Column, Column]:
    """Which slice of its key a row is in (ascending with the order), and which part of the slice, if its rows are full ties.

    A crowded position is the upper end of its slice, so its rows come after the others there; the same holds for ties within it.
    """
    below = F.when(F.col("bounds").isNull(), 0).otherwise(rank(F.col("bounds"), F.col(order[0])))
    if "crowded" not in hot.columns:
        return F.struct(below.alias("s")), F.lit(0)
    near = F.when(F.size("crowded") > 0, F.get("crowded", rank(F.col("crowded"), F.col(order[0]), "at")))
    crowd = F.when(near["at"] == F.col(order[0]), near)
    inside, tie = F.lit(0), crowd.isNotNull()
    if len(order) > 1:
        inside = F.when(crowd.isNull(), 0).otherwise(rank(crowd["inner"], F.col(order[1])))
        tied = F.get(crowd["ties"], rank(crowd["ties"], F.col(order[1])))
        tie = F.when(crowd.isNull(), False).otherwise(F.coalesce(tied == F.col(order[1]), F.lit(False)))
    # Maps cannot be hashed; rows that agree in all else share a part.
    told = [F.col(f"`{f.name}`") for f in df.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    part = F.when(tie, F.pmod(F.xxhash64(*told), crowd["parts"])).otherwise(0)
    return F.struct(below.alias("s"), crowd.isNotNull().alias("c"), inside.alias("i"), tie.alias("t")), part


def before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    last: Mapping[str, Column] | None = None,
    largest: Mapping[str, Column] | None = None,
    hot: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Add, per entry of `last`, its latest non-NULL value over strictly earlier rows of the same keys, and per
    entry of `largest` its maximum over them. `hot` must have been measured on `order`. `rows`, if known, is how many rows `df` has: with many
    of them there are more tasks, so that none sorts more than fits its memory."""
    keys, order = list(keys), list(order)
    last, largest = dict(last or {}), dict(largest or {})

    def running(partition: list[str]) -> dict[str, Column]:
        w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        cols = {name: F.last(value, ignorenulls=True).over(w) for name, value in last.items()}
        return cols | {name: F.max(value).over(w) for name, value in largest.items()}

    if hot is None:
        return _dealt(df, keys, rows).withColumns(running(keys))

    at, part = _slices(df, order, hot)
    tagged = df.join(broadcast_if_small(hot), keys, "left").withColumns({"_slice": at, "_part": part, "_cut": F.col("bounds").isNotNull()})
    # The bounds stay behind: a row goes on with the number of its slice. Both passes read what was written.
    tagged = write_stage(tagged.drop(*[c for c in hot.columns if c not in keys]), "sliced")
    solved = _dealt(tagged, [*keys, "_slice", "_part"], rows).withColumns(running([*keys, "_slice", "_part"]))

    position = F.struct(*order)
    at_end = [
        F.max_by(value, F.when(value.isNotNull(), position)).alias(name) for name, value in last.items()
    ] + [F.max(value).alias(name) for name, value in largest.items()]
    ends = tagged.filter("_cut").groupBy(*keys, "_slice").agg(*at_end)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys,
        "_slice",
        *[F.last(name, ignorenulls=True).over(earlier).alias(f"_in_{name}") for name in last],
        *[F.max(name).over(earlier).alias(f"_in_{name}") for name in largest],
    )
    # One row per slice of a hot key, with whole states, so its size is measured.
    joined = solved.join(broadcast_if_small(write_stage(carried, "carried")), [*keys, "_slice"], "left")
    merged = {name: F.coalesce(name, f"_in_{name}") for name in last}
    merged |= {name: F.greatest(name, f"_in_{name}") for name in largest}
    return joined.withColumns(merged).drop("_slice", "_part", "_cut", *[f"_in_{n}" for n in merged])
