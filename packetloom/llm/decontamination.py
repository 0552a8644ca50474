"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of `WINDOW` words (an item of fewer words is one window). A window is the sequence of its shingles, and it
occurs in a document only if all of them do, so any one of them is a sufficient prefix: the rarest over all documents leads
to the fewest candidates. The steps:

1. Every run of words of a document meets the shingles of all items by hash, and by word. What is met is written once: where which
   shingle stands.
2. Shingles are ordered by how often they were met, over all documents; each window is joined by its rarest one.
3. A candidate has to begin and to end within its document (positional and length bound).
4. It is verified by all its shingles, each at its own place, which is equality of all words.

Only DataFrame functions are used. The table of shingles is broadcast only after its size was checked, beyond that Spark joins by shuffle.

Defined cases: a NULL text has no words; items without words have no windows; equal windows of several items count for each; repeated rows of
documents come back repeated, with equal results; a NULL item id counts as no item but its words are hit; empty tables give no rows, or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetloom.llm.common import staged, words
from packetloom.llm.shingles import KEY, gram_hash, gram_text, grams, key_of, keyed, word_count
from packetloom.operators.joins import broadcast_if_small

WINDOW = 10
SHINGLE = 3


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`win, parts, length, items` for the distinct windows of `items` (item_id, text)."""
    listed = items.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    cut = listed.withColumn("length", length).withColumn("at", F.explode(starts))
    cut = cut.select("item_id", "length", F.slice("words", F.col("at"), F.col("length")).alias("parts"))
    return cut.groupBy(F.concat_ws(" ", "parts").alias("win"), "parts", "length").agg(F.collect_set("item_id").alias("items"))


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`win, length, size, at, gram`: the shingles of each window with their places; short windows have shorter ones."""
    size = F.least("length", F.lit(shingle))
    at = F.sequence(F.lit(0), F.col("length") - size)
    spread = windows.withColumn("size", size).select("win", "parts", "length", "size", F.explode(at).alias("at"))
    return spread.select("win", "length", "size", "at", F.slice("parts", F.col("at") + 1, F.col("size")).alias("gram"))


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """`doc, text_hash, start, length, win`, where windows occur in `docs` (as made by `keyed`), and the windows."""
    windows = staged(item_windows(items, window), "windows")
    parts = staged(window_shingles(windows, shingle), "window-shingles")
    known = parts.select("size", "gram").distinct()
    met = []
    for size in sorted(r.size for r in parts.select("size").distinct().collect()):  # at most `shingle` sizes
        own = known.filter(F.col("size") == size).select(
            gram_hash(*[F.get("gram", F.lit(j)) for j in range(size)]).alias("h"), F.concat_ws(" ", "gram").alias("name")
        )
        found = grams(docs, size).join(broadcast_if_small(own), "h")
        found = found.filter(gram_text(size) == F.col("name"))
        met.append(found.select(*KEY, "n_words", "pos", "name"))
    if not met:
        none = docs.select(*KEY, F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("win")).filter("false")
        return none, windows
    places = staged(reduce(DataFrame.unionByName, met), "shingle-places")
    named = parts.withColumn("name", F.concat_ws(" ", "gram"))
    counts = places.groupBy("name").agg(F.count("*").alias("n"))
    ordered = named.join(counts, "name").groupBy("win", "length").agg(
        F.min(F.struct("n", "name", "at")).alias("first"), F.count("*").alias("there")
    )
    whole = named.groupBy("win").agg(F.count("*").alias("needed"))
    # A window with a shingle that was met nowhere cannot occur.
    prefixes = ordered.join(whole, "win").filter("there = needed").select("win", "length", "needed", "first.name", "first.at")
    candidates = places.join(prefixes, "name").withColumn("start", F.col("pos") - F.col("at"))
    candidates = candidates.filter("start >= 0 AND start + length <= n_words").select(*KEY, "start", "length", "win", "needed").distinct()
    expected = candidates.join(named.select("win", "at", "name"), "win").withColumn("pos", F.col("start") + F.col("at"))
    verified = expected.join(places.select(*KEY, "pos", "name").distinct(), [*KEY, "pos", "name"])
    verified = verified.groupBy(*KEY, "start", "length", "win", "needed").agg(F.count("*").alias("equal")).filter("equal = needed")
    return verified.select(*KEY, "start", "length", "win"), windows


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """`doc_id, n_words, n_hit, n_items, items_sha256, contaminated` for every row of `docs` (doc_id, text)."""
    rows = keyed(docs.select("doc_id", "text"))
    found, windows = occurrences(rows, items, window, shingle)
    found = staged(found, "window-places")
    end = F.col("start") + F.col("length")
    earlier = Window.partitionBy(*KEY).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(earlier), F.lit(0))))
    spans = found.select(*KEY, "start", "length").distinct()
    hit = spans.withColumn("fresh", fresh).groupBy(*KEY).agg(F.sum("fresh").cast("long").alias("n_hit"))
    ids = found.select(*KEY, "win").distinct().join(windows.select("win", F.explode("items").alias("item")), "win")
    listed = ids.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("ids"))
    marks = hit.join(listed, KEY, "left")
    none = F.array().cast("array<string>")
    return (
        rows.select("doc_id", *KEY, word_count(F.col("text")).alias("n_words")).join(marks, KEY, "left")
        .withColumn("ids", F.coalesce("ids", none)).withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
        .select(
            "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
            F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs` in which no window of an item occurs, with the columns of `docs`."""
    found, _ = occurrences(keyed(docs.select("doc_id", "text")), items, window, shingle)
    marked = staged(found.select(*KEY).distinct(), "contaminated")
    names = {c: f"_{c}" for c in KEY}
    hit = marked.select(*[F.col(c).alias(n) for c, n in names.items()])
    doc, text_hash = key_of(docs["doc_id"], docs["text"])
    return docs.join(hit, (doc == hit["_doc"]) & (text_hash == hit["_text_hash"]), "left_anti")
