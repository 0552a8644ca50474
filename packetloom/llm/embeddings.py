"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

Fit, on a bounded sample: centre the unit vectors, take their principal axes and turn these until signs fit best (alternate
between the best signs and the best rotation), then cut each axis at its median so that bits are balanced. A rotation gives as many
bits as the vectors have dimensions; several rotations from different starts give further bits. Bits are cut into pieces, one
Hamming table per piece, and vectors that agree in a piece are candidates, which the original vectors decide.

The length of a piece follows the number of vectors, so buckets stay small, and the number of tables follows from it and from the recall
asked for: at cosine c a bit differs with chance arccos(c) / pi. That takes bits to be independent, so the recall is measured on the
sample's near pairs too, and tables are added until it is reached. Vectors of one length that are no more than `EXACT` are one bucket, which finds
all their links. Nothing caps a bucket: a full one is cut into blocks and every
pair of blocks is compared as one matrix product that gives counts per vector and a spanning forest, never all pairs. A pair met in
several tables counts in the first only.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components link with nothing and are components of their own; vectors
link with those of their own length only. Equal vectors are one class with a size. Repeated rows are vectors like any other. A NULL id takes part, but names a
component only if it has no other. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import components, dealt, hashed_share, join_spread, local_forest, staged

COSINE = 0.95
RECALL = 0.97
#: About so many vectors the rotations are learned from.
SAMPLE = 4096
BUCKET_MEAN = 8
#: Up to so many vectors of a length are compared without tables.
EXACT = 4096
#: Tables at most.
TABLES = 256
BLOCK = 512


def usable(vector: Column) -> Column:
    """No NULL, no zero, every component there and finite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def plan_tables(vectors: int, dim: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits per piece and number of tables."""
    bits = min(dim, 60, max(8, math.ceil(math.log2(max(vectors, 1) / BUCKET_MEAN + 1))))
    agree = (1 - math.acos(min(1.0, max(-1.0, cosine))) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree))) if agree < 1 else 1


def learn_rotations(sample: np.ndarray, count: int, rounds: int = 30) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per rotation a matrix and the thresholds of its bits."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    dim = unit.shape[1]
    mean = unit.mean(axis=0)
    _, axes = np.linalg.eigh((unit - mean).T @ (unit - mean))
    main = (unit - mean) @ axes
    made = []
    for k in range(count):
        turn, _ = np.linalg.qr(np.random.default_rng(k).normal(size=(dim, dim)))
        for _ in range(rounds):
            signs = np.where(main @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(main.T @ signs)
            turn = left @ right
        whole = axes @ turn
        made.append((whole, np.median(unit @ whole, axis=0)))
    return made


def codes_of(vectors: np.ndarray, rotations: list[tuple[np.ndarray, np.ndarray]], bits: int, tables: int) -> np.ndarray:
    """One whole number per vector and table."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    pieces = []
    weight = 1 << np.arange(bits, dtype=np.int64)
    for turn, cut in rotations:
        signs = (unit @ turn > cut).astype(np.int64)
        pieces += [signs[:, i : i + bits] @ weight for i in range(0, signs.shape[1] - bits + 1, bits)]
    return np.stack(pieces[:tables], axis=1)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)


def encode(classes: DataFrame, rotations: list, bits: int, tables: int, dim: int) -> DataFrame:
    """`class, vector, n, codes` for `class, vector, n`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = codes_of(_matrix(batch.column("vector"), dim), rotations, bits, tables)
                offsets = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * tables)
                lists = pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(run, f"class long, vector {kind}, n long, codes array<long>")


def compare(pairs: DataFrame, dim: int, tables: int, cosine: float) -> DataFrame:
    """Per pair of blocks and class: `class`, `links` (vectors linked here and in no earlier table) and `root`, the smallest class it
    is connected to here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = {}
            for side in ("x", "y"):
                rows = batch.column(side)
                starts = rows.offsets.to_numpy()
                items = rows.flatten()
                vectors = _matrix(items.field("vector"), dim)
                vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
                codes = items.field("codes").flatten().to_numpy().reshape(-1, tables)
                sides[side] = (starts - starts[0], items.field("class").to_numpy(), items.field("n").to_numpy(), vectors, codes)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for k, (at, equal) in enumerate(zip(batch.column("at").to_pylist(), batch.column("equal").to_pylist())):
                (_, xc, xn, xv, xk), (_, yc, yn, yv, yk) = (
                    (None, *(part[s[0][k] : s[0][k + 1]] for part in s[1:])) for s in (sides["x"], sides["y"])
                )
                near = xv @ yv.T >= cosine
                if equal:
                    np.fill_diagonal(near, False)
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                first = ~(xk[i, :at] == yk[j, :at]).any(axis=1)
                names = np.unique(np.concatenate([xc, yc]))
                a, b = np.searchsorted(names, xc[i]), np.searchsorted(names, yc[j])
                links = np.zeros(len(names), dtype=np.int64)
                np.add.at(links, a[first], yn[j[first]])
                if not equal:
                    np.add.at(links, b[first], xn[i[first]])
                out.append((names, links, names[local_forest(len(names), a, b)]))
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["class", "links", "root"])

    return pairs.mapInArrow(run, "class long, links long, root long")


def learn_tables(sample: np.ndarray, vectors: int, cosine: float, recall: float) -> tuple[list, int, int]:
    """Rotations, bits per piece and number of tables: as planned, and more until the near pairs of the sample are found."""
    dim = sample.shape[1]
    bits, tables = plan_tables(vectors, dim, cosine, recall)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    rows = [np.nonzero(np.triu(unit[i : i + BLOCK] @ unit.T >= cosine, i + 1)) for i in range(0, len(unit), BLOCK)]
    a = np.concatenate([r + i * BLOCK for i, (r, _) in enumerate(rows)])
    b = np.concatenate([c for _, c in rows])
    while True:
        rotations = learn_rotations(sample, math.ceil(tables / (dim // bits)))
        codes = codes_of(sample, rotations, bits, tables)
        met = np.zeros(len(a), dtype=bool)
        for k in range(codes.shape[1]):
            met |= codes[a, k] == codes[b, k]
        if not len(a) or met.mean() >= recall or tables >= TABLES:
            return rotations, bits, tables
        tables = min(TABLES, tables + max(1, tables // 2))


def links_of_length(classes: DataFrame, dim: int, count: int, cosine: float, recall: float, sample: int, block: int) -> DataFrame:
    """`class, links, root` (see `compare`) for `classes` (class, vector, n) of one length."""
    if count <= EXACT:
        tables = 1
        coded = classes.select("class", "vector", "n", F.array(F.lit(0).cast("long")).alias("codes"))
    else:
        some = sorted(hashed_share(classes.select("class", "vector"), sample, "class").collect())
        rotations, bits, tables = learn_tables(np.array([r.vector for r in some], dtype=np.float64), count, cosine, recall)
        coded = staged(encode(classes.select("class", "vector", "n"), rotations, bits, tables, dim), "vector-codes")
    buckets = coded.select("class", F.posexplode("codes").alias("at", "code"))
    sizes = buckets.groupBy("at", "code").agg(F.count("*").alias("size")).filter("size > 1")
    part = F.pmod(F.xxhash64("class", "at"), F.ceil(F.col("size") / block)).cast("int")
    live = buckets.join(sizes, ["at", "code"]).withColumn("part", part)
    item = F.struct("class", "vector", "n", "codes").alias("item")
    blocks = staged(
        live.join(coded.select("class", item), "class").groupBy("at", "code", "part")
        .agg(F.collect_list("item").alias("x"), F.first("size").alias("size")),
        "vector-blocks",
    )
    own = blocks.select("at", F.lit(True).alias("equal"), "x", F.col("x").alias("y"))
    cut = blocks.filter(F.col("size") > block)
    # Every pair of blocks of a bucket has a key of its own, so the pairs of a full bucket go to many tasks.
    last = F.ceil(F.col("size") / block).cast("int") - 1
    left = cut.filter(F.col("part") < last).select("at", "code", F.col("part").alias("i"), F.explode(F.sequence(F.col("part") + 1, last)).alias("j"), "x")
    right = cut.filter(F.col("part") > 0).select(
        "at", "code", F.explode(F.sequence(F.lit(0), F.col("part") - 1)).alias("i"), F.col("part").alias("j"), F.col("x").alias("y")
    )
    count = cut.agg(F.sum(last - F.col("part"))).first()[0] or 0
    crossed = dealt(left.join(right, ["at", "code", "i", "j"]), count, "at", "code", "i", "j").select("at", F.lit(False).alias("equal"), "x", "y")
    return compare(own.unionByName(crossed), dim, tables, cosine)


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, sample: int = SAMPLE, block: int = BLOCK
) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every row of `vectors` (vec_id, embedding)."""
    rows = vectors.select("vec_id", F.when(usable(F.col("embedding")), F.col("embedding")).alias("vector"))
    lonely = rows.filter("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    # Equal vectors are one class; its name is a hash of the components and of their number.
    keyed = rows.filter("vector IS NOT NULL").withColumn("class", F.xxhash64(F.size("vector"), "vector"))
    classes = staged(
        keyed.groupBy("class", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("rep"), F.first(F.size("vector")).alias("dim")),
        "vector-classes",
    )
    lengths = sorted(classes.groupBy("dim").agg(F.count("*").alias("classes"), F.sum("n").alias("rows")).collect())
    none = vectors.sparkSession.createDataFrame([], "class long, links long, root long")
    own = [links_of_length(classes.filter(F.col("dim") == r.dim), r.dim, r.classes, cosine, recall, sample, block) for r in lengths]
    found = staged(reduce(DataFrame.unionByName, own, none), "vector-links")

    roots = components(found.filter("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b")), "vector-components")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = staged(
        classes.select("class", "n", "rep").join(counts, "class", "left")
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .select("class", "n", "rep", F.coalesce("root", "class").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "vector-roots",
    )
    lowest = named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    labelled = join_spread(named.withColumnRenamed("n", "copies"), lowest, ["root"], sum(r.classes for r in lengths))
    labelled = labelled.drop("n").withColumnRenamed("copies", "n")
    linked = join_spread(keyed.select("vec_id", "class"), labelled, ["class"], sum(r["rows"] for r in lengths))
    done = linked.select("vec_id", "n_links", "component_id").unionByName(lonely)
    return done.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
