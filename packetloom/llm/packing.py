"""Mixture-controlled packing by deficit round-robin over source queues.

Documents are turned into token ids, queue up by source, and fill windows of a fixed length one after the other. In each round a
queue earns credit in proportion to its source's target share and sends whole documents while its credit covers them; what it
could not send stays as its deficit, for the next window. A document that reaches the end of a window goes on in the next
one, so only the very last window is padded.

Queues are cut into buckets of a few megabytes, each packed by one task, by ranges of the whole sequence of windows: a document's place
in its source's queue (prefix sums per source, over cells dealt by hash) over its source's target share tells at what point of the
sequence it is due, so a bucket holds of each source what the target shares ask of it there. A bucket starts where the one before it
ends: how many tokens all earlier buckets hold gives the position in the open window, and the place of a source's first document its
deficit, which is never more than one document. Buckets run at the same time and still give what one pass from bucket to bucket would.

The target shares are those of the tokens themselves unless given. All tokens are packed in any case: once a source ends, the others go
on in proportion to their shares.

Defined cases: a NULL text is empty and has the end id alone; a NULL source is a source of its own; a queue goes by cell, id,
length, then ids; repeated rows are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from packetloom.llm.common import over_texts, same, staged, sums_before

WINDOW = 4096
END_ID = 2
BUCKET_BYTES = 4_000_000
#: Cells a bucket's bytes are dealt into before places in queues are summed up.
CELLS = 16
_CACHE_WORDS = 300_000
_CACHE_PARTS = 500_000
_loaded: dict[int, "WordIds"] = {}


def id_kind(vocabulary: str) -> str:
    """Two bytes per id where the vocabulary allows it; the largest number is kept free."""
    held = json.loads(vocabulary)
    ids = [*held["model"]["vocab"].values(), *[t["id"] for t in held.get("added_tokens", [])]]
    return "<u2" if max(ids) < 65535 else "<u4"


class WordIds:
    """Token ids of texts by way of words: the vocabulary never joins what white space parts, so ids of words are kept and reused.

    A new word of plain letters, digits and signs is cut where the vocabulary's own pattern cuts it, and its parts are looked up
    too; any other word goes to the tokenizer whole. Both stores take no more once full; what they lack is worked out anew.
    """

    # The vocabulary file's split pattern for lower-case words of the letters below (fixed by the file).
    # The space parts words that are joined by one.
    LETTERS = re.compile(r"[ -~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
    PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u00ff0-9 ]+| ")

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.kind = np.dtype(id_kind(vocabulary))
        self.free = np.iinfo(self.kind).max  # no id; stands between words
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {" ": np.array([self.free], dtype=self.kind).tobytes()}
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(pieces.values()) + 1, dtype=bool)
        self.last[[i for piece, i in pieces.items() if piece.endswith("</w>")]] = True
        self.end = np.array([END_ID], dtype=self.kind).tobytes()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in found]

    def _learn_parts(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts, a hundred to a call, cut again behind the ids that end a word."""
        made: dict[str, bytes] = {}
        groups = [parts[i : i + 100] for i in range(0, len(parts), 100)]
        for group, ids in zip(groups, self._whole([" ".join(g) for g in groups])):
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(group):
                data, size = ids.tobytes(), self.kind.itemsize
                cuts = [0, *(ends * size).tolist()]
                made.update((p, data[i:j]) for p, i, j in zip(group, cuts, cuts[1:]))
            else:
                made.update((p, one.tobytes()) for p, one in zip(group, self._whole(group)))
        return made

    def _plain(self, text: str) -> bool:
        return "<|" not in text and self.LETTERS.fullmatch(text) is not None

    def _learn_plain(self, words: list[bytes]) -> dict[bytes, bytes]:
        own = self.parts
        parts = self.PARTS.findall(b" ".join(words).decode("utf-8").lower())
        found = list(map(own.get, parts))
        lacking = [i for i, v in enumerate(found) if v is None]
        if lacking:
            fresh = self._learn_parts(list({parts[i] for i in lacking}))
            if len(own) < _CACHE_PARTS:
                own.update((p, v) for p, v in fresh.items() if len(p) <= 64)
            for i in lacking:
                found[i] = fresh[parts[i]]
        data, size = b"".join(found), self.kind.itemsize
        at = np.flatnonzero(np.frombuffer(data, dtype=self.kind) == self.free) * size
        return {w: data[i:j] for w, i, j in zip(words, [0, *(at + size).tolist()], [*at.tolist(), len(data)])}

    def _learn(self, new: set[bytes]) -> dict[bytes, bytes]:
        plain, whole, words = [], [], list(new)
        for group in (words[i : i + 100] for i in range(0, len(words), 100)):
            if self._plain(b" ".join(group).decode("utf-8")):
                plain += group
            else:
                for word in group:
                    (plain if self._plain(word.decode("utf-8")) else whole).append(word)
        known = self._learn_plain(plain) if plain else {}
        known.update((w, one.tobytes()) for w, one in zip(whole, self._whole([w.decode("utf-8") for w in whole])))
        return known

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids in `kind`, the end id last."""
        own, words, ends = self.words, [], [0]
        for text in texts:
            words += (text or "").encode("utf-8").split()
            ends.append(len(words))
        # One look per word, which may lie anywhere in a large store.
        found = list(map(own.get, words))
        lacking = [i for i, v in enumerate(found) if v is None]
        if lacking:
            fresh = self._learn({words[i] for i in lacking})
            if len(own) < _CACHE_WORDS:
                own.update((w, v) for w, v in fresh.items() if len(w) <= 64)
            for i in lacking:
                found[i] = fresh[words[i]]
        return [b"".join(found[i:j]) + self.end for i, j in zip(ends, ends[1:])]


def word_ids(broadcast) -> WordIds:
    """One per worker and vocabulary."""
    key = hash(broadcast.value)
    if key not in _loaded:
        _loaded[key] = WordIds(broadcast.value)
    return _loaded[key]


def round_robin(queues: Mapping[str | None, list[int]], share: Mapping, deficit: Mapping, window: int) -> list[tuple[str | None, int]]:
    """The order in which documents leave: (source, number in its queue). `queues` has the lengths in tokens."""
    order = []
    at = dict.fromkeys(queues, 0)
    credit = {s: deficit[s] for s in queues}
    active = sorted(queues, key=lambda s: (s is None, s or ""))
    while active:
        # Skip the rounds in which no queue could send.
        waits = [math.ceil((queues[s][at[s]] - credit[s]) / (share[s] * window)) for s in active]
        rounds = max(1, min(waits))
        left = []
        for s in active:
            credit[s] += rounds * share[s] * window
            queue, i = queues[s], at[s]
            while i < len(queue) and credit[s] >= queue[i]:
                credit[s] -= queue[i]
                order.append((s, i))
                i += 1
            at[s] = i
            if i < len(queue):
                left.append(s)
        active = left
    return order


def queue_of(source: str | None) -> str:
    """The name of a source's queue, never NULL."""
    return "" if source is None else f"s{source}"


class Course:
    """How far the whole sequence is once each queue has sent its share times u, or all it has."""

    def __init__(self, total: int, given: Mapping[str, tuple[float, int]]):
        """`given`: weight and tokens of the queues with a target share; the others end together, at u = total."""
        rest = total - sum(n for _, n in given.values())
        self.parts = [(w, n) for w, n in [(rest / max(total, 1), rest), *given.values()] if n]
        self.turns = np.array(sorted({0.0, *(n / w for w, n in self.parts)}))
        self.places = np.array([sum(min(w * u, n) for w, n in self.parts) for u in self.turns])

    def place(self, turn: Column) -> Column:
        return sum((F.least(turn * F.lit(float(w)), F.lit(float(n))) for w, n in self.parts), F.lit(0.0))

    def turn(self, place: float) -> float:
        return float(np.interp(place, self.places, self.turns))


def pack(
    docs: DataFrame,
    vocabulary: str,
    window: int = WINDOW,
    bucket_bytes: int = BUCKET_BYTES,
    shares: Mapping[str | None, float] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document of `docs` (doc_id, text, source); `vocabulary` is the path of a tokenizer file.

    `with_ids` adds the piece's ids as an array. `shares` gives target weights by source; a source without one gets its own share of
    the tokens.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    held, kind = spark.sparkContext.broadcast(content), id_kind(content)  # a vocabulary file: its size does not follow the data
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    cell = F.pmod(F.xxhash64("doc_id", "source", F.length("text")), F.lit(buckets * CELLS))
    queue = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    rows = docs.select("doc_id", "text", queue.alias("queue"), cell.alias("cell"))

    def encode(texts: list[str | None]) -> dict[str, object]:
        own = word_ids(held)
        ids = own.ids(texts)
        return {"n": [len(i) // own.kind.itemsize for i in ids], "ids": pa.array(ids, type=pa.binary())}

    # Written once with its ids, so that texts are tokenized once and counts are read without them.
    encoded = staged(over_texts(rows, "n long, ids binary", encode, ["doc_id", "queue", "cell"]), "pack-ids")
    counts = staged(encoded.groupBy("queue", "cell").agg(F.sum("n").alias("n")), "pack-counts")
    by_queue = counts.groupBy("queue").agg(F.sum("n").alias("of_queue"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    weights = {queue_of(name): weight / sum(shares.values()) for name, weight in (shares or {}).items()}
    named = by_queue.filter(F.col("queue").isin(list(weights))).collect() if weights else []
    course = Course(total, {r["queue"]: (weights[r["queue"]], r["of_queue"]) for r in named})
    bucket_tokens = max(1, math.ceil(total / buckets))
    share = F.col("of_queue") / F.lit(max(total, 1))
    for name, weight in weights.items():
        share = F.when(F.col("queue") == name, F.lit(weight)).otherwise(share)
    own = sums_before(counts, ["queue"], "cell", "n", "served", step=256)
    state = staged(own.join(by_queue, "queue").select("queue", "cell", "served", share.alias("share")), "pack-state")

    def placed(rows: DataFrame, *order: str) -> DataFrame:
        """With `at`, the tokens before a document in its queue, and its bucket. Rows that agree in `order` may swap places."""
        earlier = Window.partitionBy("queue", "cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        joined = rows.join(state, ["queue", "cell"])
        found = joined.withColumn("at", F.col("served") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        # A fixed part of its length into a document, other for each queue, so that queues of one document do not all start together.
        part = F.pmod(F.xxhash64("queue"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        due = course.place((F.col("at") + part * F.col("n")) / F.col("share"))
        return found.withColumn("bucket", F.floor(due / F.lit(float(bucket_tokens))).cast("long"))

    by_bucket = placed(encoded.select("doc_id", "queue", "cell", "n"), "doc_id", "n").groupBy("bucket").agg(F.sum("n").alias("all"))
    starts = staged(sums_before(staged(by_bucket, "pack-buckets"), [], "bucket", "all", "before").select("bucket", "before"), "pack-starts")
    due = placed(encoded, "doc_id", "n", "ids").select("bucket", "queue", "at", "doc_id", "ids", "share")

    fields = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(f, pa.int64()) for f in fields] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def fill(docs_in: pa.Table, start: pa.Table) -> pa.Table:
        _loaded.clear()  # the words kept for encoding are not needed any more in this worker
        queues: dict = {}
        share, deficit = {}, {}
        begin = course.turn(start.column("bucket")[0].as_py() * bucket_tokens)
        columns = (docs_in.column(c).to_pylist() for c in ("queue", "at", "doc_id", "ids", "share"))
        for queue, at, doc, ids, weight in sorted(zip(*columns), key=lambda r: r[:2]):
            if queue not in queues:
                queues[queue], share[queue], deficit[queue] = [], weight, weight * begin - at
            queues[queue].append((doc, np.frombuffer(ids, dtype=kind).astype("<u4")))
        order = round_robin({s: [len(ids) for _, ids in q] for s, q in queues.items()}, share, deficit, window)
        place = start.column("before")[0].as_py()
        out = []
        for source, i in order:
            doc, ids = queues[source][i]
            n, done = len(ids), 0
            while done < n:
                sequence, offset = divmod(place, window)
                take = min(n - done, window - offset)
                piece = ids[done : done + take]
                row = (doc, done, take, zlib.crc32(piece.tobytes()), n, sequence, offset)
                out.append((*row, piece.astype(np.int32)) if with_ids else row)
                done += take
                place += take
        cols = list(zip(*out)) if out else [[] for _ in schema]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    spark_schema = ", ".join(f"`{f}` long" for f in fields) + (", ids array<int>" if with_ids else "")
    return due.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInArrow(fill, spark_schema)
