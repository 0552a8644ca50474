"""Language model scores of whole documents.

Counts of all training words come from Spark: every task counts its own documents, and sums meet by word. The network (see `gru`)
knows the `WORDS` most frequent words one by one, and all others by `RARE` classes of word endings; within a class a rarer word has its
share of the counts, an unseen one half a count. So each word of any text has a probability, and unseen words are treated as the unigram
base treats them.

Training: documents of the training folds run through truncated backpropagation, another part of them in each round (`PART`) and all of them once,
where they lie, each task from the same values and sums of squared gradients; both are averaged, weighted by tokens, in groups until few are
left, and the next round goes on from them. What is learned from grows with the table; the network does not.

Reading: after the counts, one pass turns each document into token numbers of two bytes and looks up the counts of the `WARM` most frequent
words, which every task holds (at most 64 bytes a word, so the table is bounded); both are written once, and training and scoring read the
numbers. Other words go by a join on the word with all counts. No document is cut, sampled or left out.

Defined cases: a NULL text is empty and has the end token alone; a NULL id is its own fold's remainder of the empty text and counts as training; repeated
rows score alike and count twice in training; an empty training set gives counts of zero; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetloom.llm import gru
from packetloom.llm.common import over_texts, same, staged

WORDS = 1024
RARE = 32
WARM = 200_000
PART = 8
ROUNDS = PART
END = b"\n"  # no word holds white space
#: Numbers of network words and rare classes, as they are written.
TOKEN = np.dtype("<u2")
_ENDING = 2
_COUNTER = 400_000


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def split(text: str | None) -> list[bytes]:
    words = (text or "").encode("utf-8").lower().split()
    words.append(END)
    return words


def rare_class(word: bytes) -> int:
    return crc32(word[-_ENDING:]) % RARE


def count_words(docs: DataFrame) -> DataFrame:
    """`word, kind, c`: how often each word occurs in `docs`; kind is its class among rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(counts: Counter) -> pa.RecordBatch:
            words = list(counts)
            kinds = pa.array([rare_class(w) for w in words], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), kinds, pa.array(counts.values(), pa.int64())], ["word", "kind", "c"]
            )

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(split(text.as_py()))
                if len(counts) > _COUNTER:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    partial = docs.select("text").mapInArrow(run, "word binary, kind int, c long")
    return partial.groupBy("word", "kind").agg(F.sum("c").alias("c"))


class Model:
    """Everything a task needs: counts of frequent words, totals, and the network's values."""

    def __init__(self, warm: list[tuple[bytes, int, int]], total: int, distinct: int, rare: dict[int, tuple[int, int]]):
        self.number = {w: i for i, (w, _, _) in enumerate(warm)}
        self.counts = np.array([c for _, _, c in warm] or [0], dtype=np.float64)
        self.log_counts = np.log10(self.counts + 0.5)
        known = min(WORDS, len(warm))
        self.shape = gru.Shape(known, RARE)
        self.token = np.array([i if i < known else known + k for i, (_, k, _) in enumerate(warm)] or [0], dtype=np.int32)
        self.total = total
        self.base_total = math.log10(total + 0.5 * (distinct + 1))
        sums = np.array([rare.get(k, (0, 0)) for k in range(RARE)], dtype=np.float64)
        self.rare_total = np.log10(sums[:, 0] + 0.5 * (sums[:, 1] + 1))
        self.values = gru.start_values(self.shape, self.counts[:known], sums[:, 0] + 0.5 * (sums[:, 1] + 1))

    def read(self, text: str | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """A text's places in the table of warm words (-1: not there), its tokens, and its other words."""
        words = split(text)
        at = np.fromiter(map(self.number.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        cold = np.flatnonzero(at < 0)
        others = [words[i] for i in cold.tolist()]
        tokens = self.token[at]
        tokens[cold] = [self.shape.words + rare_class(w) for w in others]
        return at, tokens, others


def token_rows(docs: DataFrame, model: Model, name: str = "network-tokens") -> DataFrame:
    """`doc_id, text_hash, n_tokens, warm, base, beside, cold, times, tokens` per row of `docs`, written once: token numbers, and what is
    known of a text without the network: its number of warm words, their share of both scores, its other words and how often they occur."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str | None]) -> dict[str, object]:
        own = held.value
        n, known, base, beside, cold, tokens = [], [], [], [], [], []
        for text in texts:
            at, numbers, others = own.read(text)
            warm_at = at[at >= 0]
            n.append(len(at))
            known.append(len(warm_at))
            # A word's log10(c + 0.5) is in the base score of all, and in the model's score of words outside the network.
            base.append(float(own.log_counts[warm_at].sum()))
            outside = warm_at[warm_at >= own.shape.words]
            kinds = numbers[numbers >= own.shape.words] - own.shape.words
            beside.append(float(own.log_counts[outside].sum()) - float(own.rare_total[kinds].sum()))
            cold.append(Counter(others))
            tokens.append(numbers.astype(TOKEN).tobytes())
        return {
            "n_tokens": np.array(n, dtype=np.int64), "warm": np.array(known, dtype=np.int64), "base": np.array(base), "beside": np.array(beside),
            "cold": pa.array([list(c) for c in cold], pa.list_(pa.binary())),
            "times": pa.array([list(c.values()) for c in cold], pa.list_(pa.int64())), "tokens": pa.array(tokens, pa.binary()),
        }

    schema = "n_tokens long, warm long, base double, beside double, cold array<binary>, times array<long>, tokens binary"
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return staged(over_texts(keyed, schema, run, ["doc_id", "text_hash"], chars=32_000_000), name)


def fit(docs: DataFrame, model: Model, rounds: int = ROUNDS, part: int = PART) -> np.ndarray:
    """The network's values after `rounds` passes over a `part`-th of the training documents each, one part after the other."""
    return fit_tokens(token_rows(docs, model), model, rounds, part)


def fit_tokens(rows: DataFrame, model: Model, rounds: int = ROUNDS, part: int = PART) -> np.ndarray:
    """`fit` from rows `doc_id, tokens` (see `token_rows`)."""
    spark, shape = rows.sparkSession, model.shape
    # Values and sums of squared gradients, one after the other.
    state = np.concatenate([model.values, np.full_like(model.values, gru.SEEN)])
    draw = F.pmod(F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) / 5), F.lit(part))
    for k in range(rounds):
        held = spark.sparkContext.broadcast(state)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            values, seen = np.split(held.value, 2)
            weight = 0
            for batch in batches:
                tokens = [np.frombuffer(t.as_py(), dtype=TOKEN) for t in batch.column("tokens")]
                if tokens:
                    values, seen = gru.train(values, shape, tokens, seen)
                    weight += sum(map(len, tokens))
            if weight:
                yield _state_row(np.concatenate([values, seen]), weight)

        trained = rows.filter(draw == k % part).select("tokens").mapInArrow(run, "state binary, weight long")
        state = average(trained, state)
        held.destroy()  # what was trained is written by now
    return np.split(state, 2)[0]


def _state_row(state: np.ndarray, weight: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([state.astype(np.float32).tobytes()], pa.binary()), pa.array([weight], pa.int64())], ["state", "weight"])


def average(rows: DataFrame, otherwise: np.ndarray, group: int = 16) -> np.ndarray:
    """The weighted mean of the rows' states, by groups, so that neither a task nor the driver holds more than a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = 0.0, 0
        for batch in batches:
            for state, w in zip(batch.column("state"), batch.column("weight")):
                total = total + np.frombuffer(state.as_py(), dtype=np.float32).astype(np.float64) * w.as_py()
                weight += w.as_py()
        if weight:
            yield _state_row(total / weight, weight)

    rows = staged(rows, "network-states")
    n = rows.count()
    while n > group:
        rows = staged(rows.repartition(math.ceil(n / group)).mapInArrow(run, "state binary, weight long"), "network-states")
        n = rows.count()
    found = [(np.frombuffer(r["state"], dtype=np.float32).astype(np.float64), r["weight"]) for r in rows.collect()]
    if not found:
        return otherwise
    return (sum(v * w for v, w in found) / sum(w for _, w in found)).astype(np.float32)


def frequent_words(counts: DataFrame, most: int | None = None) -> list[tuple[bytes, int, int]]:
    """(word, kind, c) of words of at most 64 bytes, the most frequent first: at most `most` (`WARM`), whole levels of frequency.

    A histogram of counts tells from which one on the words are few enough, so no task sends more than it has of these.
    """
    most = WARM if most is None else most
    level = F.floor(F.log2("c") * 16)
    short = counts.filter(F.octet_length("word") <= 64).withColumn("level", level)
    room, least = most, None
    for row in short.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 16 * 64 levels
        room -= row["count"]
        if room < 0:
            break
        least = row.level
    if least is None:
        return []
    found = short.filter(F.col("level") >= least).select("word", "kind", "c").toArrow()
    return sorted(zip(*(found.column(c).to_pylist() for c in ("word", "kind", "c"))), key=lambda r: (-r[2], r[0]))


def score_documents(docs: DataFrame, held_out: int = 1) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` for every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    training = docs.filter(fold(F.col("doc_id")) != held_out)
    counts = staged(count_words(training), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    warm = frequent_words(counts)
    frequent = spark.createDataFrame([(bytearray(w),) for w, _, _ in warm[:WORDS]], "word binary")
    rest = counts.join(F.broadcast(frequent), "word", "left_anti").groupBy("kind").agg(F.sum("c"), F.count("*")).collect()
    model = Model(warm, total, distinct, {r[0]: (r[1], r[2]) for r in rest})
    rows = token_rows(docs, model)
    shape = model.shape
    values = spark.sparkContext.broadcast(fit_tokens(rows.filter(fold(F.col("doc_id")) != held_out), model))

    def run(texts: list[bytes]) -> dict[str, object]:
        return {"net": gru.score(values.value, shape, [np.frombuffer(t, dtype=TOKEN) for t in texts])}

    known = ["n_tokens", "warm", "base", "beside"]
    scored = staged(over_texts(rows, "net double", run, ["doc_id", "text_hash", *known], text="tokens", chars=10_000_000), "network-scores")
    key = ["doc_id", "text_hash"]
    others = rows.select(*key, F.explode(F.arrays_zip("cold", "times")).alias("w")).select(*key, F.col("w.cold").alias("word"), F.col("w.times").alias("n"))
    found = others.join(counts.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = found.groupBy(*key).agg(
        F.sum(F.col("n") * F.log10(c + F.lit(0.5))).alias("cold_log"), F.sum(F.when(c > 0, F.col("n"))).alias("cold_known")
    )
    # Repeated rows share a key, and so their sums hold each of them.
    copies = scored.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")
    joined = scored.join(sums, same(scored, sums, *key), "left").select(scored["*"], "cold_log", "cold_known")
    joined = joined.join(copies, same(joined, copies, *key), "left").select(joined["*"], F.coalesce("copies", F.lit(1)).alias("copies"))
    rest_log = F.coalesce("cold_log", F.lit(0.0)) / F.col("copies")
    return joined.select(
        "doc_id", (fold(F.col("doc_id")) == held_out).alias("held_out"), "n_tokens",
        (F.col("warm") + F.coalesce("cold_known", F.lit(0)) / F.col("copies")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + rest_log - F.col("n_tokens") * F.lit(model.base_total)).alias("base_score"),
        (F.col("net") + F.col("beside") + rest_log).alias("score"),
    )
