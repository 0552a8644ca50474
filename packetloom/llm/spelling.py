"""Spelling variant grouping with a frequency-vector trie.

Letters are dealt into groups of about equal weight, and a word's frequency vector counts its letters per group. Words that differ by one inserted,
deleted or replaced letter have vectors that differ by at most one surplus and one deficit. Words are arranged in a trie by the
counts of one group after another; a depth-first search takes a block of words down the trie and spends their budget of one surplus and
one deficit on the way; the words of the leaves it reaches are verified letter by letter.

The trie is cut for Spark at its upper levels: a shard holds the words of one length and one choice of the first counts. A word asks the shards that
its budget can reach, each pair of shards from one side only, so each near pair is found exactly once. Shards with many letters are cut
into several tries and the words that ask them into several blocks, and each pair of trie and block is a row of its own, dealt out by its
own key, so a frequent vector spreads over tasks. Nothing is left out, and no group is larger than a block.

Defined cases: a NULL text has no words and a NULL id reads as empty; repeated rows count each time; of near words with
the same count the smallest in code-point order is the form; words of any length and letters of any script are compared; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import over_texts, staged

RUN = "[A-Za-zÀ-ÿ]"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
GROUPS = 12
#: Letters of a trie or of a block of asking words, and pairs or letters looked at in one go.
BLOCK_LETTERS = 1 << 17
STEP = 1 << 18

Change = Callable[[bytes, str], str]


def crc_deletion(doc: bytes, run: str, divisor: int = 31) -> str:
    """`run` without one letter if the checksum of document and run is divisible, else as it is."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc + b":"))
    if h % divisor:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, change: Change | None = None) -> DataFrame:
    """`word, n`: runs of letters of `docs` (doc_id, text) with A-Z in lower case, after `change` (document, run), if they are long and
    frequent enough. A change may take letters away, but adds none. Added up per piece of a batch, then per map task, before the shuffle."""
    pattern = re.compile(RUN + "{%d,}" % max(1, min_length))

    def made(texts: list[str | None], ids: list) -> dict[str, object]:
        total: Counter[str] = Counter()
        for text, doc in zip(texts, ids):
            runs = Counter(pattern.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
            if change is None:
                total.update(runs)
                continue
            name = b"" if doc is None else str(doc).encode()
            for run, n in runs.items():
                word = change(name, run)
                if len(word) >= min_length:
                    total[word] += n
        # One row per text is due: the first carries all words of the piece.
        lists = [list(total.items())] + [[]] * (len(texts) - 1)
        return {"words": pa.array(lists, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))}

    rows = docs.select(F.col("doc_id").cast("string").alias("doc"), "text")
    counted = over_texts(rows, "words array<struct<word: string, n: long>>", made, [], also=["doc"])
    return counted.select(F.inline("words")).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- Vectors and tries ------------------------------------------------------------------------------------------------------------


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after another, and the words' lengths."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return codes, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


def letter_groups(words: DataFrame, groups: int = GROUPS) -> dict[int, int]:
    """The group of each code point: the most frequent first, each to the lightest group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, times = np.unique(letters_of(batch.column("word").to_pylist())[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(times)], ["code", "n"])

    sums = words.select("word").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    weight, group = [0] * groups, {}
    for row in sorted(sums, key=lambda r: (-r.n, r.code)):  # at most as many as there are code points
        g = min(range(groups), key=lambda i: (weight[i], i))
        group[row.code] = g
        weight[g] += row.n
    return group


def vectors_of(words: list[str], group: dict[int, int], groups: int = GROUPS) -> np.ndarray:
    codes, lengths = letters_of(words)
    names, back = np.unique(codes, return_inverse=True)
    dealt = np.array([group[c] for c in names.tolist()], dtype=np.int64)[back] if len(codes) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(words)), lengths)
    return np.bincount(row * groups + dealt, minlength=len(words) * groups).reshape(-1, groups)


class Trie:
    """Words arranged by the counts of one letter group after another. Nodes of a level are numbered in order; per level `keys` holds
    parent and count of each node, so a child is found by one search."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        rows = vectors[self.order]
        self.wide = int(rows.max(initial=0)) + 3
        self.keys = []
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(rows.shape[1]):
            keys, node = np.unique(node * self.wide + rows[:, level] + 1, return_inverse=True)
            self.keys.append(keys)
        self.leaf_starts = np.searchsorted(node, np.arange(len(self.keys[-1]) + 1)) if self.keys else np.zeros(1, np.int64)

    def search(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking row, word) whose vectors differ by at most one surplus and one deficit.

        Depth first over pieces of at most `STEP` (row, node) pairs, each with what is left of its budget.
        """
        rows = np.arange(len(asked))
        start = np.zeros_like(rows)
        stack = [(0, rows, start, start, start)]
        while stack:
            level, row, node, surplus, deficit = stack.pop()
            if level == len(self.keys):
                count = self.leaf_starts[node + 1] - self.leaf_starts[node]
                offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield np.repeat(row, count), self.order[np.repeat(self.leaf_starts[node], count) + offset]
                continue
            keys = self.keys[level]
            found = []
            for step in (-1, 0, 1):
                fits = (surplus == 0) if step > 0 else (deficit == 0) if step < 0 else np.ones(len(row), bool)
                r, n = row[fits], node[fits]
                count = asked[r, level] + step
                key = n * self.wide + count + 1
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                there = (keys[at] == key) & (count >= 0) & (count + 1 < self.wide)
                found.append((r[there], at[there], surplus[fits][there] + (step > 0), deficit[fits][there] + (step < 0)))
            row, node, surplus, deficit = (np.concatenate(c) for c in zip(*found))
            for i in range(0, len(row), STEP):
                stack.append((level + 1, *(c[i : i + STEP] for c in (row, node, surplus, deficit))))


def one_apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For rows of letters of equal length: whether one is replaced; of lengths that differ by one: whether one is inserted."""
    size = short.shape[1]
    if long.shape[1] == size:
        return (short != long).sum(axis=1) == 1
    straight, shifted = short != long[:, :size], short != long[:, 1:]
    # The inserted letter may stand anywhere up to the first difference and beyond the last difference of the shifted rest.
    first = np.where(straight.any(axis=1), straight.argmax(axis=1), size)
    last = np.where(shifted.any(axis=1), size - 1 - shifted[:, ::-1].argmax(axis=1), -1)
    return last < first


def near_pairs(asking: list[str], held: list[str], group: dict[int, int], groups: int = GROUPS) -> tuple[np.ndarray, np.ndarray]:
    """Places (in `asking`, in `held`) of words one letter apart. Words of `held` have one length, and no asking word is longer."""
    trie = Trie(vectors_of(held, group, groups))
    codes, _ = letters_of(held)
    long = codes.reshape(len(held), -1)
    lengths = np.fromiter(map(len, asking), dtype=np.int64, count=len(asking))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for size in np.unique(lengths):
        own = np.flatnonzero(lengths == size)
        words = [asking[i] for i in own]
        short = letters_of(words)[0].reshape(len(own), -1)
        step = max(1, 16 * STEP // max(1, int(size)))
        for row, word in trie.search(vectors_of(words, group, groups)):
            for i in range(0, len(row), step):
                r, w = row[i : i + step], word[i : i + step]
                good = one_apart(short[r], long[w])
                out.append((own[r[good]], w[good]))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *c]) for c in zip(*out)) if out else (none, none)


# --- Shards -----------------------------------------------------------------------------------------------------------------------


def reachable(key: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Shards (length, first counts) a word of shard `key` asks: its own, those of its length that its budget reaches and that come later,
    and those with one letter more."""
    length, *counts = key

    def moved(*steps: tuple[int, int]) -> tuple[int, ...]:
        now = list(counts)
        for at, by in steps:
            now[at] += by
        return tuple(now)

    places = range(len(counts))
    same = [moved((i, by)) for i in places for by in (1, -1)] + [moved((i, 1), (j, -1)) for i in places for j in places if i != j]
    same = [(length, *c) for c in same if min(c) >= 0 and c > tuple(counts)]
    longer = [(length + 1, *counts)] + [(length + 1, *moved((i, 1))) for i in places]
    return [key, *same, *longer]


def cut_levels(words: int) -> int:
    """How many counts, beside the length, name a shard: more for more words."""
    return 2 + max(0, len(str(max(words, 1))) - 5)


def with_shards(words: DataFrame, group: dict[int, int], groups: int, levels: int) -> DataFrame:
    """`word, n, own, asks`: the key of each word's shard and of those it asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            first = vectors_of(texts, group, groups)[:, :levels].tolist()
            keys = [(len(t), *c) for t, c in zip(texts, first)]
            asks = {k: [",".join(map(str, a)) for a in reachable(k)] for k in dict.fromkeys(keys)}
            cols = [pa.array([asks[k][0] for k in keys], pa.string()), pa.array([asks[k] for k in keys], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *cols], ["word", "n", "own", "asks"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, own string, asks array<string>")


def near_words(words: DataFrame, groups: int = GROUPS, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """`word, near, near_n`, both ways, for all words of `words` (word, n; distinct words) that are one letter apart."""
    group = letter_groups(words, groups)
    placed = staged(with_shards(words, group, groups, min(groups, cut_levels(words.count()))), "spelling-shards")
    held = placed.select(F.col("own").alias("shard"), F.struct("word", "n").alias("item"))
    asked = placed.select("word", "n", F.posexplode("asks").alias("at", "shard"))
    asked = asked.select("shard", F.struct("word", "n", (F.col("at") == 0).alias("home")).alias("item"))
    length = F.substring_index("shard", ",", 1).cast("long")

    def parts(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("shard").agg(F.ceil(F.count("*") * F.first(length) / block_letters).cast("int").alias(name))

    sizes = staged(parts(held, "tries").join(parts(asked, "blocks"), "shard"), "spelling-sizes")
    tries = held.join(sizes, "shard").withColumn("trie", F.pmod(F.xxhash64("item"), F.col("tries")).cast("int"))
    tries = tries.groupBy("shard", "trie").agg(F.collect_list("item").alias("held"), F.first("blocks").alias("blocks"))
    blocks = asked.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "item"), F.col("blocks")).cast("int"))
    blocks = blocks.groupBy("shard", "block").agg(F.collect_list("item").alias("asking"), F.first("tries").alias("tries"))
    # Each pair of trie and block has a key of its own, so the pairs of one shard go to many tasks.
    tries = tries.select("shard", "trie", "held", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    blocks = blocks.select("shard", "block", "asking", F.explode(F.sequence(F.lit(0), F.col("tries") - 1)).alias("trie"))
    pairs = tries.join(blocks, ["shard", "trie", "block"]).select("held", "asking")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                held, asking = (batch.column(c)[k].values for c in ("held", "asking"))
                (b, b_n), (a, a_n) = ((items.field("word").to_pylist(), items.field("n")) for items in (held, asking))
                home = asking.field("home").to_pylist()
                found = near_pairs(a, b, group, groups)
                # Two words of one shard ask each other; the question of the smaller one counts.
                both = [(i, j) for i, j in zip(*(f.tolist() for f in found)) if not home[i] or a[i] < b[j]]
                if both:
                    at_a, at_b = (pa.array(c) for c in zip(*both))
                    left, right = pa.array(a, pa.string()).take(at_a), pa.array(b, pa.string()).take(at_b)
                    cols = [pa.concat_arrays(c) for c in ([left, right], [right, left], [b_n.take(at_b), a_n.take(at_a)])]
                    yield pa.RecordBatch.from_arrays(cols, ["word", "near", "near_n"])

    return pairs.mapInArrow(search, "word string, near string, near_n long")


def roots_of(forms: DataFrame) -> DataFrame:
    """`word, root` for `word, form`: the last of a chain of forms, by jumps of doubling length. Counts rise along a chain, so it ends."""
    jumps = staged(forms.select("word", F.col("form").alias("to")), "spelling-jumps")
    while True:
        further = jumps.select(F.col("word").alias("to"), F.col("to").alias("beyond"))
        jumps = staged(jumps.join(further, "to", "left").select("word", F.coalesce("beyond", "to").alias("to"),
                                                               F.col("beyond").isNotNull().alias("moved")), "spelling-jumps")
        moved = jumps.filter("moved").count()
        jumps = jumps.drop("moved")
        if not moved:
            return jumps.withColumnRenamed("to", "root")


def group_variants(words: DataFrame, ratio: int = RATIO, groups: int = GROUPS, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """`word, form, root, n, n_near, form_n` for every row of `words` (word, n; distinct words).

    The form is the near word of largest count, if that is at least `ratio` times the word's own.
    """
    words = staged(words.select("word", "n"), "spelling-words")
    near = near_words(words, groups, block_letters)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left").withColumn("best_n", -F.col("best.less"))
    fits = F.col("best_n") >= F.col("n") * ratio
    known = staged(
        known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                     F.when(fits, F.col("best.near")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")),
        "spelling-forms",
    )
    roots = roots_of(known.filter("form IS NOT NULL"))
    named = known.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
