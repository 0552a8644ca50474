"""Line dedup with two Bloom filters.

A line's key is the line without white space at its ends and with A-Z in lower case. One pass over the texts writes the 16-byte digests of
each row's distinct keys. From these, two filters of equal length are built: each occurrence of a key sets two bits in the once-seen
filter, and bits that were set before go to the twice-seen filter. The filters are cut into segments and made in parallel: tasks send the bits
they set, segment by segment, and a task that merges a segment moves to the twice-seen part what an earlier one had set. A key of
two rows has both its bits in the twice-seen filter, so none is missed; a key of one row is there only by chance.

Only suspected repeats, whose bits are all seen twice, shuffle: their rows are counted by digest (128 bits, taken as exact), and those in
enough rows are confirmed. The first occurrence, if it is to stay, is the one in the row with the smallest id.

Bounds: the twice-seen filter is broadcast. It takes a byte per key, up to `max_bits` bits; beyond that chance suspects become more and
the digests shuffled with them, at most all digests (some 5% of the text), while the result stays the same. A key found in a third of all rows is
counted in map tasks first; when confirmed keys go back to their rows, keys with over a thousandth of all suspects (so at most a thousand) are
broadcast, the others join by shuffle.

Defined cases: each row is a document, and rows that agree in id and text share their result; a key counts once per row; a NULL
or empty text is one empty line; lines whose keys are shorter than `min_chars` stay; if all lines go, the text is empty; NULL ids take part
and come last when the first occurrence is chosen; other columns are left behind, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import join_spread, over_texts, staged

MIN_DOCS = 10
MIN_CHARS = 1
#: Largest length of a filter (64 MB).
MAX_BITS = 1 << 29
BITS_PER_KEY = 8
SEGMENT_BITS = 1 << 15
#: Bits a task gathers before it sends them on.
GATHERED = 1 << 22


def line_keys(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Lines of a text and their keys. Bytes strip and lower-case exactly the ASCII white space and letters."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    return lines, [line.strip().lower() for line in lines]


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "surrogatepass")) >= min_chars)


def digests(keys: list[bytes]) -> np.ndarray:
    """Two whole numbers per key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype="<i8").reshape(-1, 2)


def row_digests(rows: DataFrame, min_chars: int) -> DataFrame:
    """`id, r1, r2, lo, hi`: per row the digests of its distinct keys as two arrays."""

    def made(texts: list[str | None]) -> dict[str, object]:
        los, his, ends = [], [], [0]
        for text in texts:
            keys = [k for k in dict.fromkeys(line_keys(text)[1]) if long_enough(k, min_chars)]
            both = digests(keys)
            los.append(both[:, 0])
            his.append(both[:, 1])
            ends.append(ends[-1] + len(keys))
        offsets = pa.array(ends, pa.int32())
        return {name: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(part))) for name, part in (("lo", los), ("hi", his))}

    return over_texts(rows, "lo array<long>, hi array<long>", made, ["id", "r1", "r2"])


def filter_bits(keys: int, max_bits: int = MAX_BITS) -> int:
    """Length of a filter: a power of two, at least one segment."""
    return min(max_bits, max(SEGMENT_BITS, 1 << (max(keys, 1) * BITS_PER_KEY - 1).bit_length()))


def bits_of(batch: pa.RecordBatch, bits: int) -> np.ndarray:
    """The two bits of each key, one row per key."""
    lo, hi = (batch.column(c).flatten().to_numpy() for c in ("lo", "hi"))
    return np.stack([lo, hi], axis=1) & (bits - 1)


def seen_twice(found: DataFrame, bits: int) -> DataFrame:
    """`segment, twice`: the twice-seen filter, as packed bits, of the keys of `found` (lo, hi)."""

    def sent(places: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        place, times = np.unique(np.concatenate(places), return_counts=True)
        again = times > 1
        segment, inside = place // SEGMENT_BITS, (place % SEGMENT_BITS).astype("<u2")
        names, starts = np.unique(segment, return_index=True)
        edges = [*starts.tolist(), len(place)]
        once = [inside[i:j].tobytes() for i, j in zip(edges, edges[1:])]
        twice = [inside[i:j][again[i:j]].tobytes() for i, j in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(once), pa.array(twice)], ["segment", "once", "twice"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: list[np.ndarray] = []
        for batch in batches:
            places.append(bits_of(batch, bits).reshape(-1))
            if sum(map(len, places)) >= GATHERED:
                yield from sent(places)
                places = []
        if sum(map(len, places)):
            yield from sent(places)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice = None, np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)

        def finished() -> pa.RecordBatch:
            packed = np.packbits(twice, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([packed])], ["segment", "twice"])

        for batch in batches:
            for segment, first, second in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != now:
                    if now is not None:
                        yield finished()
                    now, once[:], twice[:] = segment, False, False
                place = np.frombuffer(first, "<u2")
                twice[place[once[place]]] = True
                twice[np.frombuffer(second, "<u2")] = True
                once[place] = True
        if now is not None:
            yield finished()

    parts = found.select("lo", "hi").mapInArrow(gather, "segment long, once binary, twice binary")
    return parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment long, twice binary")


def broadcast_filter(found: DataFrame, bits: int) -> Broadcast:
    whole = np.zeros(bits // 8, dtype=np.uint8)
    step = SEGMENT_BITS // 8
    for row in seen_twice(found, bits).collect():  # at most `max_bits` bits in all
        whole[row.segment * step : (row.segment + 1) * step] = np.frombuffer(row.twice, np.uint8)
    return found.sparkSession.sparkContext.broadcast(whole)


def suspects(found: DataFrame, seen: Broadcast, bits: int) -> DataFrame:
    """`id, r1, r2, lo, hi`, a row per key that is in the twice-seen filter."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = bits_of(batch, bits)
            hit = (seen.value[places >> 3] >> (places & 7).astype(np.uint8) & 1).all(axis=1)
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("lo").offsets.to_numpy()))
            at, chosen = pa.array(row[hit]), pa.array(hit)
            cols = [batch.column(c).take(at) for c in ("id", "r1", "r2")]
            cols += [batch.column(c).flatten().filter(chosen) for c in ("lo", "hi")]
            yield pa.RecordBatch.from_arrays(cols, ["id", "r1", "r2", "lo", "hi"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(probe, f"id {kind}, r1 long, r2 long, lo long, hi long")


def repeated(found: DataFrame, min_docs: int, max_bits: int) -> DataFrame:
    """`r1, r2, drop`: per row its keys that are in at least `min_docs` rows, each with whether the row is the key's first."""
    bits = filter_bits(found.agg(F.sum(F.size("lo"))).first()[0] or 0, max_bits)
    found = staged(suspects(found, broadcast_filter(found, bits), bits), "suspected-lines")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "r1", "r2"))
    counts = found.groupBy("lo", "hi").agg(F.count("*").alias("n"), first.alias("first")).filter(F.col("n") >= min_docs)
    counts = staged(counts.select("lo", "hi", "n", F.col("first.r1").alias("f1"), F.col("first.r2").alias("f2")), "repeated-lines")
    met = join_spread(found, counts, ["lo", "hi"], found.count())
    here = (F.col("r1") == F.col("f1")) & (F.col("r2") == F.col("f2"))
    return met.groupBy("r1", "r2").agg(F.collect_set(F.struct("lo", "hi", here.alias("here"))).alias("drop"))


def kept_lines(text: str | None, drop: list[dict] | None, keep_first: bool) -> tuple[str, int, int]:
    """Text without its lines to drop, the number of its lines, and of those dropped."""
    lines, keys = line_keys(text)
    if not drop:
        return text or "", len(lines), 0
    first = {(d["lo"], d["hi"]): keep_first and d["here"] for d in drop}
    kept = []
    for line, name in zip(lines, map(tuple, digests(keys).tolist())):
        if name not in first:
            kept.append(line)
        elif first[name]:
            kept.append(line)
            first[name] = False
    return b"\n".join(kept).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(kept)


def dedup_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep_first: bool = False, max_bits: int = MAX_BITS
) -> DataFrame:
    """`doc_id, text, n_lines, n_dropped` for every row of `docs` (doc_id, text).

    Lines whose key is in at least `min_docs` rows are dropped, all of them or all but the first.
    """
    marks = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), F.col("text"), F.col("doc_id"))
    rows = docs.select(F.col("doc_id").alias("id"), "text", marks[0].alias("r1"), marks[1].alias("r2"))
    drops = repeated(staged(row_digests(rows, min_chars), "line-digests"), min_docs, max_bits)
    joined = rows.join(drops, ["r1", "r2"], "left")

    def made(texts: list[str | None], lists: list) -> dict[str, object]:
        out = [kept_lines(t, d, keep_first) for t, d in zip(texts, lists)]
        return {"kept": pa.array([o[0] for o in out], pa.string()), "n_lines": pa.array([o[1] for o in out], pa.int64()),
                "n_dropped": pa.array([o[2] for o in out], pa.int64())}

    done = over_texts(joined, "kept string, n_lines long, n_dropped long", made, ["id"], also=["drop"])
    return done.select(F.col("id").alias("doc_id"), F.col("kept").alias("text"), "n_lines", "n_dropped")
