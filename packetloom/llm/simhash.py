"""SimHash near-dedup with BK-trees.

A document's fingerprint has 64 bits, each set if it is set in more than half of the hashes of the document's word shingles.
Documents link when their fingerprints differ in few bits, and linked ones form a component.

The search: fingerprints are made distinct first, so exact copies cost one node. Bits are cut into blocks; fingerprints
within the radius agree in some of the blocks whole, whichever bits differ, so each choice of blocks sends a fingerprint to one shard and
no pair is missed. A shard is a BK-tree (children keyed by their Hamming distance to the parent) and its own
fingerprints are the queries, which follow only edges within the radius of their distance to a node. Shards over
`SHARD_NODES` are cut into several trees, each of which is sent to every block of the shard's queries. A single broadcast of all
trees would grow with the data, so trees travel by a join on their shard instead.

Defined cases: a NULL or blank text has the fingerprint zero and links as any other; a NULL id takes part but is never a
component's id unless the component has no other; repeated rows come back repeated; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import components, dealt, join_spread, local_forest, over_texts, staged

BITS = 64
RADIUS = 4
SHINGLE = 4
SHARD_NODES = 1024
#: Distinct fingerprints a shard should hold on average; decides only into how many blocks bits are cut.
SHARD_MEAN = 32
_HASH = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(parts))
    starts, ends = starts[: len(parts) - k + 1], ends[k - 1 :]
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(starts), 65536):
        spans = zip(starts[at : at + 65536].tolist(), ends[at : at + 65536].tolist())
        hashes = np.fromiter((_HASH(joined[i:j]) for i, j in spans), dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, text_hash, fp` for every row of `docs` (doc_id, text)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return over_texts(rows, "fp long", lambda texts: {"fp": [fingerprint(t, shingle) for t in texts]}, ["doc_id", "text_hash"])


class Forest:
    """One BK-tree per tree number, all built and searched together, level by level."""

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        self.values = values
        n = len(values)
        first = np.unique(tree, return_index=True)
        self.roots = dict(zip(first[0].tolist(), first[1].tolist()))
        under = np.array([self.roots[t] for t in tree.tolist()], dtype=np.int64)
        left = np.setdiff1d(np.arange(n), first[1])
        parents, edges, nodes = [], [], []
        while len(left):
            dist = np.bitwise_count(values[left] ^ values[under[left]]).astype(np.int64)
            _, at, back = np.unique(under[left] * (BITS + 1) + dist, return_index=True, return_inverse=True)
            child = left[at]  # the first of each distance becomes the child, the others go on below it
            parents.append(under[child])
            edges.append(dist[at])
            nodes.append(child)
            below = child[back]
            keep = below != left
            under[left] = below
            left = left[keep]
        key = np.concatenate(parents) * (BITS + 1) + np.concatenate(edges) if nodes else np.zeros(0, dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.child = np.concatenate(nodes)[order] if nodes else np.zeros(0, dtype=np.int64)

    def within(self, queries: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, node) within the radius, by following edges whose length is within it of the query's distance."""
        q = np.arange(len(queries))
        node = np.array([self.roots[t] for t in tree.tolist()], dtype=np.int64)
        found_q, found_n = [], []
        while len(q):
            dist = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = dist <= radius
            found_q.append(q[hit])
            found_n.append(node[hit])
            base = node * (BITS + 1)
            lo = np.searchsorted(self.key, base + np.maximum(dist - radius, 0))
            hi = np.searchsorted(self.key, base + np.minimum(dist + radius, BITS), side="right")
            count = hi - lo
            total = int(count.sum())
            offset = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
            node = self.child[np.repeat(lo, count) + offset]
            q = np.repeat(q, count)
        return np.concatenate(found_q), np.concatenate(found_n)


def block_choices(nodes: int, radius: int = RADIUS, mean: int = SHARD_MEAN) -> list[int]:
    """Bit masks, one per choice of blocks that have to agree.

    With `radius + k` blocks, k blocks agree whole. More blocks give longer keys and smaller shards, but more choices; every
    number finds all pairs.
    """
    for k in (1, 2, 3, 4):
        blocks = radius + k
        if k == 4 or nodes / 2 ** (BITS * k // blocks) <= mean:
            break
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    whole = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(whole[i] for i in chosen) for chosen in combinations(range(blocks), k)]


def near_links(nodes: DataFrame, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """Links `a, b` between distinct fingerprints (fp) that connect exactly what lies within the radius.

    Each tree and query block gives a spanning forest of its links, so a group of n copies gives about n rows per shard, not n * n.
    """
    masks = block_choices(nodes.count(), radius)
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])
    rows = nodes.select("fp", F.posexplode(keys).alias("choice", "key"))
    sizes = rows.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    live = rows.join(sizes, ["choice", "key"]).withColumn(
        "shard", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / shard_nodes)).cast("int")
    )
    trees = live.groupBy("choice", "key", "shard").agg(F.collect_list("fp").alias("tree"), F.first("n").alias("n"))
    trees = staged(trees, "bk-trees")
    alone = trees.filter(F.col("n") <= shard_nodes).select("tree", F.col("tree").alias("queries"))
    cut = trees.filter(F.col("n") > shard_nodes)
    # Every pair of trees of a bucket has a key of its own, so the pairs of a full bucket go to many tasks.
    last = F.ceil(F.col("n") / shard_nodes).cast("int") - 1
    held = cut.select("choice", "key", F.col("shard").alias("i"), F.explode(F.sequence(F.col("shard"), last)).alias("j"), "tree")
    asked = cut.select("choice", "key", F.explode(F.sequence(F.lit(0), F.col("shard"))).alias("i"), F.col("shard").alias("j"), F.col("tree").alias("queries"))
    count = cut.agg(F.sum(last - F.col("shard") + 1)).first()[0] or 0
    pairs = dealt(held.join(asked, ["choice", "key", "i", "j"]), count, "choice", "key", "i", "j").select("tree", "queries")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            work = np.fromiter((len(t) * len(q) for t, q in zip(batch["tree"], batch["queries"])), dtype=np.int64)
            piece = np.cumsum(work) // (4 * shard_nodes * shard_nodes)
            for k in np.unique(piece):
                part = batch[piece == k]
                trees_in, queries_in = list(part["tree"]), list(part["queries"])
                number = np.arange(len(part))
                values = np.concatenate(trees_in).astype(np.int64).view(np.uint64)
                asked = np.concatenate(queries_in).astype(np.int64).view(np.uint64)
                forest = Forest(values, np.repeat(number, [len(t) for t in trees_in]))
                q, node = forest.within(asked, np.repeat(number, [len(t) for t in queries_in]), radius)
                names, back = np.unique(np.concatenate([values, asked]).view(np.int64), return_inverse=True)
                root = names[local_forest(len(names), back[: len(values)][node], back[len(values) :][q])]
                yield pd.DataFrame({"a": names[names != root], "b": root[names != root]})

    return alone.unionByName(pairs).mapInPandas(search, "a long, b long")


def _linked(docs: DataFrame, radius: int, shingle: int, shard_nodes: int) -> DataFrame:
    """`doc_id, text_hash, fp, root, component_id` for every row of `docs`; root names a component where ids repeat."""
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs")), "fingerprint-nodes")
    roots = components(near_links(nodes, radius, shard_nodes), "simhash-links")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "rep", "docs", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))
    named = join_spread(rooted, lowest, ["root"], nodes.count()).select("fp", "root", "component_id", F.col("docs").alias("n"))
    return join_spread(marked, named, ["fp"], marked.count()).select("doc_id", "text_hash", "fp", "root", "component_id")


def simhash_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """`doc_id, fingerprint, component_id` for every row of `docs`; component_id is the smallest doc_id reachable by links."""
    found = _linked(docs, radius, shingle, shard_nodes)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """The rows of `docs` without near copies: of each component the row with the smallest id stays.

    Rows without an id cannot be told apart and all stay. Where several texts of a component have its smallest id, one of them stays, and
    of rows that agree in id and text the one whose other columns come first.
    """
    found = _linked(docs, radius, shingle, shard_nodes).filter(F.col("doc_id") == F.col("component_id"))
    chosen = found.groupBy("component_id", "root").agg(F.min("text_hash").alias("_hash"))
    chosen = staged(chosen.select(F.col("component_id").alias("_doc"), "_hash"), "chosen")
    at = (docs["doc_id"] == chosen["_doc"]) & (F.xxhash64(docs["text"]) == chosen["_hash"])
    first = staged(docs.join(chosen, at, "left_semi"), "one-of-each")
    key = ["doc_id", "text"]
    doubled = first.groupBy("doc_id", F.xxhash64("text").alias("_hash")).count().filter("count > 1").select(F.col("doc_id").alias("_doc"), "_hash")
    again = (first["doc_id"] == doubled["_doc"]) & (F.xxhash64(first["text"]) == doubled["_hash"])
    others = [c for c in docs.columns if c not in key]
    several = first.join(doubled, again, "left_semi").groupBy(*key).agg(F.min(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in others])).alias("row"))
    several = several.select(*[c if c in key else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    single = first.join(doubled, again, "left_anti")
    return single.unionByName(several).unionByName(docs.filter("doc_id IS NULL"))
