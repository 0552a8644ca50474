"""Co-training over the whole unlabelled pool."""

import random

import numpy as np
from pyspark.sql import functions as F

from packetloom.llm import quality

DOCS = "doc_id long, text string, lang string, source string"


def corpus(n, sources=12, seed=3):
    """Good and bad documents, told apart by words and, independently, by their source; either side is wrong at times."""
    rng = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        good = rng.random() < 0.6
        kind = "fine" if good != (rng.random() < 0.02) else "poor"
        source = f"{'s' if good != (rng.random() < 0.02) else 't'}{rng.randrange(sources)}"
        words = [f"{kind}{'abcd'[rng.randrange(4)]}" for _ in range(3)] + [f"w{'xyzuv'[rng.randrange(5)]}" for _ in range(8)]
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", source))
        truth[i] = good
    return rows, truth


def test_the_exchange_helps(spark):
    """Few labels leave most sources unseen; the text view's pseudo-labels teach the metadata view about them."""
    rows, truth = corpus(4000, sources=25)
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    labels = spark.createDataFrame([(i, int(truth[i]), 0) for i in range(100)], "doc_id long, quality int, toxic int")
    rest, found = rows[100:], {}
    right = np.array([truth[r[0]] for r in rest])
    for rounds in (0, 3):
        model = quality.train(docs, labels, rounds=rounds)
        scored = model.score(*model.features([r[1] for r in rest], [r[2] for r in rest], [r[3] for r in rest]))
        found[rounds] = [float(((p >= 0.5) == right).mean()) for p in scored]
    text, meta, both = zip(found[0], found[3])
    assert meta[1] > meta[0] + 0.02 and both[1] > both[0] - 0.005 and text[1] > text[0] - 0.01, found


def test_the_surest_of_all_rows_are_given(spark, monkeypatch):
    monkeypatch.setattr(quality, "SURE", 0.5)
    rows, _ = corpus(500)
    features = quality.Features({f"{k}{c}": i for i, (k, c) in enumerate((k, c) for k in ("fine", "poor") for c in "abcd")})
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    measures = np.array([quality.layout(r[1]) for r in rows])
    edges = np.quantile(measures, np.arange(1, 10) / 10, axis=0).T
    pool = quality.over_texts(docs.withColumn("row", F.col("doc_id")), features.schema, features.read, ["row", "lang", "source"])
    weights = np.random.default_rng(1).normal(size=len(features.vocabulary) + 2)
    p = quality.predict(quality.text_features([r[1] for r in rows], features.vocabulary), weights)
    for label, most in ((1, 25), (0, 40)):
        got = {r.row for r, _ in quality.surest(pool, features, edges, weights, 0, {label: most})}
        sure = np.floor(np.maximum(p, 1 - p) * 10_000)
        mine = np.flatnonzero((p >= 0.5) == bool(label))
        cut = np.sort(sure[mine])[::-1][most - 1]
        # all that are surer than the last one taken, and of those as sure as it a share
        assert {int(i) for i in mine if sure[i] > cut} <= got <= {int(i) for i in mine if sure[i] >= cut}


def test_rows_of_one_id_are_bounded(spark):
    rows = [(1, f"fine words {i}", "en", "s") for i in range(300)] + [(2, f"poor stuff {i}", "en", "t") for i in range(300)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(spark.createDataFrame(rows, DOCS), labels, labelled=100)
    assert model is not None and model.score(*model.features(["fine words", "poor stuff"], ["en"] * 2, ["s", "t"]))[2].tolist()[0] > 0.5
