"""Quality classifier by co-training.

Two classifiers look at a document from two sides: its words and signs (text view), and what is known about the page without its words: source,
language, size and layout, which counts kinds of characters (metadata view). Both start from the labelled rows. In every round each one scores
all unlabelled rows, in Spark, labels those it is surest about, and the other one learns from these. In the end the two are calibrated on
labelled rows that neither has seen, combined by a third small model, and all documents are scored.

What is bounded: about `LABELLED` labelled documents, chosen by a hash, are used for fitting, `WORDS` words are features, those whose presence
tells the labels apart most clearly in the labelled sample, and a view gives away `GIVEN` rows in the first round, twice as many in the
second, and so on. The three models are small and are fitted on the driver from these rows; the pool the rows are chosen from is every
unlabelled document. Scores are made for every document, from its whole text.

A document is good if its label says quality 1 and toxic 0 (a missing toxic mark counts as 0, a missing quality leaves the row out; of several
labels of a document the worst counts).

Defined cases: a NULL text is empty, NULL metadata is a value of its own; repeated rows score alike and are given away once; of rows that are
equally sure a hash decides; words of any length count; without labels of both kinds nothing can be
learned and every document has the score 1 and is kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetloom.llm.common import hashed_share, over_texts, staged

LABELLED = 20_000
WORDS = 600
#: Standard errors from which on a word tells the labels apart; rare words of a few documents do not reach it.
CLEAR = 4.0
ROUNDS = 3
#: Pseudo-labels a classifier gives away in the first round (twice as many in the second, and so on), and how sure it has to be.
GIVEN = 500
SURE = 0.95
THRESHOLD = 0.5
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")
_STEM = 5
_BINS = 10
_SOURCES, _LANGS = 64, 16
_LAYOUT = ("chars", "lines", "line_length", "upper", "digits", "signs", "distinct", "word_length", "spaces")


def tokens(text: str | None) -> set[str]:
    """Words in lower case, the beginnings of longer words, and runs of signs."""
    whole = set(_TOKEN.findall((text or "").lower()))
    return whole | {t[:_STEM] + "-" for t in whole if len(t) > _STEM}


def layout(text: str | None) -> list[float]:
    """Size, shape and kinds of characters of a page; no word of it is known by name."""
    text = text or ""
    n = len(text) or 1
    words = text.split()
    lines = text.count("\n") + 1
    letters = text.encode("utf-8", "surrogatepass")
    upper = len(letters) - len(letters.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(letters) - len(letters.translate(None, b"0123456789"))
    signs = len(letters) - len(letters.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    return [
        float(np.log1p(len(text))), float(lines), n / lines, upper / n, digits / n, signs / n, len(set(words)) / max(1, len(words)),
        n / max(1, len(words)), text.count(" ") / n,
    ]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    return np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 12) -> np.ndarray:
    """Weights, the bias last, by Newton steps with a ridge penalty. Rows are taken in blocks, so features may stay small types."""
    m = x.shape[1] + 1
    penalty = np.full(m, ridge)
    penalty[-1] = 1e-6
    w = np.zeros(m)
    for _ in range(steps):
        h, slope = np.diag(penalty), -penalty * w
        for at in range(0, len(x), 2048):
            part = np.hstack([x[at : at + 2048].astype(np.float64), np.ones((len(x[at : at + 2048]), 1))])
            p = sigmoid(part @ w)
            h += (part * (p * (1 - p) + 1e-9)[:, None]).T @ part
            slope += part.T @ (y[at : at + 2048] - p)
        move = np.linalg.solve(h, slope)
        w += move
        if np.abs(move).max() < 1e-5:
            break
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(np.concatenate([x[at : at + 4096] @ w[:-1] for at in range(0, len(x), 4096)]) + w[-1]) if len(x) else np.zeros(0)


@dataclass
class Model:
    """Both views, their calibration and their combination; a few kilobytes."""

    vocabulary: dict[str, int]
    edges: np.ndarray  # layout measures by bins
    text_weights: np.ndarray
    meta_weights: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    mix: np.ndarray

    def features(self, texts: list, langs: list, sources: list) -> tuple[np.ndarray, np.ndarray]:
        return text_features(texts, self.vocabulary), meta_features([layout(t) for t in texts], langs, sources, self.edges)

    def score(self, x_text: np.ndarray, x_meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        text = predict(logit(predict(x_text, self.text_weights))[:, None], self.text_scale)
        meta = predict(logit(predict(x_meta, self.meta_weights))[:, None], self.meta_scale)
        return text, meta, predict(np.stack([logit(text), logit(meta)], axis=1), self.mix)


def repeats(text: str | None) -> float:
    """1 if more than a tenth of the words, and more than five, only repeat the word before."""
    words = (text or "").split()
    again = sum(map(str.__eq__, words, words[1:]))
    return float(again > 5 and again * 10 > len(words))


def text_features(texts: list, vocabulary: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(texts), len(vocabulary) + 1), dtype=np.uint8)
    for i, t in enumerate(texts):
        x[i, [vocabulary[w] for w in tokens(t) if w in vocabulary]] = 1
        x[i, -1] = repeats(t)
    return x


def meta_features(measures: list, langs: list, sources: list, edges: np.ndarray) -> np.ndarray:
    n, m = len(measures), len(_LAYOUT)
    x = np.zeros((n, m * _BINS + _LANGS + _SOURCES), dtype=np.uint8)
    rows = np.arange(n)
    values = np.array(measures).reshape(n, m)
    for k in range(m):
        x[rows, k * _BINS + np.searchsorted(edges[k], values[:, k], side="right")] = 1
    for column, (at, size) in ((langs, (m * _BINS, _LANGS)), (sources, (m * _BINS + _LANGS, _SOURCES))):
        x[rows, [at + (0 if v is None else 1 + crc32(v.encode()) % (size - 1)) for v in column]] = 1
    return x


class Features:
    """Features of rows, as Spark holds them: places of the vocabulary, measures of the layout, language and source."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary
        self.schema = "present array<int>, measures array<double>"

    def read(self, texts: list[str | None]) -> dict[str, object]:
        x = text_features(texts, self.vocabulary)
        present = pa.array([np.flatnonzero(r).astype(np.int32) for r in x], pa.list_(pa.int32()))
        return {"present": present, "measures": pa.array([layout(t) for t in texts], pa.list_(pa.float64()))}

    def views(self, present: list, measures: list, langs: list, sources: list, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(present), len(self.vocabulary) + 1), dtype=np.uint8)
        for i, places in enumerate(present):
            x[i, places] = 1
        return x, meta_features(measures, langs, sources, edges)


def surest(pool: DataFrame, features: Features, edges: np.ndarray, weights: np.ndarray, view: int, most: dict[int, int]) -> list:
    """The rows of `pool` that one view is surest about, at most `most` per label and at least `SURE`, as (row, label).

    All rows are scored where they are. Counts of rows by rounded sureness tell from where on they are few enough; of rows that are equally
    sure a share is chosen by a hash.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features.views(*(batch.column(c).to_pylist() for c in ("present", "measures", "lang", "source")), edges)
            p = predict(x[view], weights)
            level = pa.array(np.minimum(np.floor(np.maximum(p, 1 - p) * 10_000), 9_999).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((p >= 0.5).astype(np.int32)), level], [*batch.schema.names, "label", "level"])

    scored = pool.mapInArrow(score, f"{_ddl(pool)}, label int, level int").filter(F.col("level") >= int(SURE * 10_000))
    levels = scored.groupBy("label", "level").count().orderBy("label", F.desc("level")).collect()  # at most 500 levels a label
    share = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = F.lit(False)
    for label, room in most.items():
        cut, part = 10_000, 0.0  # levels above `cut` are taken whole, of its own rows a part
        for row in levels:
            if row.label == label and room > 0:
                cut, part = row.level, min(1.0, room / row["count"])
                room -= row["count"]
        picked = picked | ((F.col("label") == label) & ((F.col("level") > cut) | ((F.col("level") == cut) & (share < part))))
    chosen = scored.filter(picked).drop("level").dropDuplicates(["row"]).collect()  # copies teach once
    return [(r, r.label) for r in sorted(chosen, key=lambda r: (r.row, r.present))]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def co_train(
    x: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: DataFrame, features: Features, edges: np.ndarray, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights of both views. Each learns from the labels and from the rows of `pool` that the other one was surest about, by far more
    rows in each round. The pool is scored whole; what is given away is bounded by `GIVEN` rows per round, view and label."""
    given: list[list] = [[], []]  # for each view the pool rows labelled by the other

    def fitted() -> list[np.ndarray]:
        weights = []
        for view in (0, 1):
            rows = [r for r, _ in given[view]]
            more = features.views([r.present for r in rows], [r.measures for r in rows], [r.lang for r in rows], [r.source for r in rows], edges)
            labels = np.array([label for _, label in given[view]], dtype=np.float64)
            weights.append(fit_logistic(np.vstack([x[view], more[view]]), np.concatenate([y, labels])))
        return weights

    weights = fitted()
    for k in range(rounds):
        most = {label: max(1, int(GIVEN * (k + 1) * np.mean(y == label))) for label in (0, 1)}
        given = [surest(pool, features, edges, weights[1 - view], 1 - view, most) for view in (0, 1)]
        weights = fitted()
    return weights[0], weights[1]


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS) -> Model | None:
    """A model from `docs` (doc_id, text, lang, source) and `labels` (doc_id, quality, toxic); None without labels of both kinds."""
    good = ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")
    marked = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(good).alias("good"))
    marked = staged(marked, "quality-labels")
    known = hashed_share(docs.select("doc_id").join(marked, "doc_id").distinct(), labelled, "doc_id")
    chosen = staged(known, "quality-chosen")
    # A bounded number of ids; of rows that share one, as many as there are ids in all.
    sample = docs.select("doc_id", "text", "lang", "source").join(F.broadcast(chosen), "doc_id")
    sample = staged(hashed_share(staged(sample.distinct(), "quality-rows"), labelled, "doc_id", "text"), "quality-sample")
    sizes = {r.good: r.n for r in sample.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    found = over_texts(sample, "words array<string>", lambda texts: {"words": [sorted(tokens(t)) for t in texts]}, ["good"])
    seen = found.select("good", F.explode("words").alias("word"))
    share = F.col("n") / (sizes[0] + sizes[1])
    # How far the share of good documents among those with the word is from the share among all, in standard errors.
    base = sizes[1] / (sizes[0] + sizes[1])
    apart = F.abs(F.col("ones") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base) + 1)
    counted = seen.groupBy("word").agg(F.count("*").alias("n"), F.sum("good").alias("ones"))
    picked = counted.filter((apart >= CLEAR) & (share < 0.9)).orderBy(F.desc(apart), "word").limit(WORDS).collect()
    features = Features({r.word: i for i, r in enumerate(picked)})

    rows = over_texts(sample, features.schema, features.read, ["doc_id", "good", "lang", "source"]).collect()
    rows.sort(key=lambda r: (crc32(str(r.doc_id).encode()), r.doc_id, r.present, r.measures))
    edges = np.quantile(np.array([r.measures for r in rows]), np.arange(1, _BINS) / _BINS, axis=0).T
    x = features.views([r.present for r in rows], [r.measures for r in rows], [r.lang for r in rows], [r.source for r in rows], edges)
    y = np.array([float(r.good) for r in rows])
    tune = np.array([crc32(str(r.doc_id).encode()) % 4 == 0 for r in rows])  # for calibration
    fit = ~tune
    if len(set(y[fit])) < 2 or len(set(y[tune])) < 2:
        fit = tune = np.ones(len(y), bool)
    pool = None
    if rounds:
        ids = docs.select("doc_id", "text", "lang", "source", F.xxhash64("doc_id", "text", "lang", "source").alias("row"))
        read = over_texts(ids, features.schema, features.read, ["doc_id", "row", "lang", "source"])
        pool = staged(read.join(marked, "doc_id", "left_anti").drop("doc_id"), "quality-pool")
    w_text, w_meta = co_train((x[0][fit], x[1][fit]), y[fit], pool, features, edges, rounds)
    raw = [logit(predict(view[tune], w))[:, None] for view, w in ((x[0], w_text), (x[1], w_meta))]
    scales = [fit_logistic(r, y[tune], ridge=1e-3) for r in raw]
    views = np.stack([logit(predict(r, s)) for r, s in zip(raw, scales)], axis=1)
    return Model(features.vocabulary, edges, w_text, w_meta, scales[0], scales[1], fit_logistic(views, y[tune], ridge=1e-2))


def _scored(docs: DataFrame, model: Model, keep: list[str], made: dict[str, str], threshold: float) -> DataFrame:
    """Columns `keep` of `docs` and those of p_text, p_meta, score, kept that `made` names, under its names."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: list, langs: list, sources: list) -> dict[str, object]:
        text, meta, both = held.value.score(*held.value.features(texts, langs, sources))
        found = {"p_text": text, "p_meta": meta, "score": both, "kept": both >= threshold}
        return {name: found[what] for what, name in made.items()}

    schema = ", ".join(f"`{name}` {'boolean' if what == 'kept' else 'double'}" for what, name in made.items())
    return over_texts(docs, schema, score, keep, also=["lang", "source"])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, p_text, p_meta, score, kept` for every row of `docs`."""
    model = train(docs, labels)
    if model is None:
        one = F.lit(1.0)
        return docs.select("doc_id", one.alias("p_text"), one.alias("p_meta"), one.alias("score"), F.lit(True).alias("kept"))
    return _scored(docs, model, ["doc_id"], {c: c for c in ("p_text", "p_meta", "score", "kept")}, threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier keeps, with the columns of `docs`."""
    model = train(docs, labels)
    if model is None:
        return docs
    mark = "_kept"
    while mark in docs.columns:
        mark += "_"
    return _scored(docs, model, docs.columns, {"kept": mark}, threshold).filter(f"`{mark}`").drop(mark)
