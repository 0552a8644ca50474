"""Samples that are bounded, pages in linear time, vectors of any length, full buckets over many tasks."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from packetloom.llm import embeddings, pages, simhash
from packetloom.llm.common import hashed_share, join_spread

# --- samples


def test_hashed_share(spark):
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("page_id"), F.col("id").cast("string").alias("html"))
    assert 800 < hashed_share(rows, 1000, "page_id", "html").count() < 1200
    three = spark.range(3).select(F.col("id").alias("page_id"), F.lit("x").alias("html"))
    assert hashed_share(three, 1000, "page_id", "html").count() == 3
    many = spark.range(10_000).select((F.col("id") % 3).alias("page_id"))
    assert hashed_share(many, 10, "page_id").count() > 0
    assert hashed_share(three.filter("false"), 10, "page_id").count() == 0


PAGE = "<body><div class=menu>Home News</div><article><p>Some words of text here.</p><div class=promo>Buy now</div></article><div class=foot>End</div></body>"


@pytest.mark.parametrize("ids", [1, 3])
def test_names_are_learned_from_few_ids(spark, ids):
    rows = spark.createDataFrame([(i % ids, PAGE) for i in range(40)], "page_id long, html string")
    scores = pages.learn_scores(rows, sample=10)
    assert scores["menu"] < 0 and scores["foot"] < 0 and scores["article"] > 0
    found = pages.extract(rows.withColumns({"url": F.lit("u"), "names": F.lit(1)}), sample=10).collect()
    assert {r.text for r in found} == {"Some words of text here."} and len(found) == 40


def test_rare_names_are_left_out(spark):
    rows = spark.createDataFrame([(i, f"<main><p class=own{i}>word word</p></main>") for i in range(50)], "page_id long, html string")
    assert "own7" in pages.learn_scores(rows) and "own7" not in pages.learn_scores(rows, names=20)
    assert "main" in pages.learn_scores(rows.filter("false"))


# --- pages


def slow_region(scores):
    best, region = 0.0, (0, 0)
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-9:
                best, region = total, (i, j + 1)
    return best, region


def test_region_is_the_largest_sum():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 2]) for _ in range(rng.randrange(0, 30))]
        i, j = pages.best_region(scores)
        assert sum(scores[i:j]) == slow_region(scores)[0]


@pytest.mark.parametrize(
    "piece",
    ["<font>", "<div>", "<div class=a>", "<p><b>", "<a href=\"x>", "<a title='x>", "</b>", "<a \"'>", "<b x='\"'>\"", "<li><i>", "<!-- ", "<", "<a <", "<header class=x>"],
)
def test_a_megabyte_of_anything_is_read_in_time(piece):
    page = "<article>start " + piece * (1_000_000 // len(piece)) + "end</article>"
    start = time.perf_counter()
    pages.main_text(page, pages.scores_of({}, {}))
    pages.count_names(page)
    assert time.perf_counter() - start < 20


def test_quotes_in_tags():
    read = lambda page: pages.main_text(page, pages.scores_of({}, {}))
    assert read('<article><a title="a > b">one</a> two <a title="odd>three</a> four</article>') == "one two three four"
    assert read("<article><a title='x\" > y'>one</a></article>") == "one"
    assert read("<article>one <a title='un") == "one"


# --- vectors


def slow_links(vectors, cosine=0.95):
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (unit @ unit.T >= cosine).sum(axis=1) - 1


@pytest.mark.parametrize("dim, count", [(2, 5), (2, 400), (3, 40), (8, 800), (64, 5000)])
def test_recall_over_sizes(spark, dim, count):
    rng = np.random.default_rng(dim * count)
    centres = rng.normal(size=(max(1, count // 4), dim))
    vectors = (centres[rng.integers(0, len(centres), count)] + rng.normal(size=(count, dim)) * 0.15).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    want = slow_links(vectors.astype(np.float64))
    assert all(got[i] <= want[i] for i in range(count)) and sum(got.values()) >= 0.95 * want.sum()


def test_recall_of_tables(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "EXACT", 0)
    rng = np.random.default_rng(6)
    for dim, count in ((4, 1500), (64, 1500)):
        centres = rng.normal(size=(count // 4, dim))
        vectors = (centres[rng.integers(0, len(centres), count)] + rng.normal(size=(count, dim)) * 0.15).astype(np.float32)
        df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
        got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
        want = slow_links(vectors.astype(np.float64))
        assert all(got[i] <= want[i] for i in range(count)) and sum(got.values()) >= 0.95 * want.sum()


def test_lengths_link_within_themselves(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [3.0, 0.01]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.1]), (6, [0.0, 1.0, 0.0]), (7, [1.0]), (8, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7), 8: (0, 8)}


# --- full buckets and keys


def test_a_full_bucket_is_searched_by_many_tasks(spark):
    fps = spark.range(20_000).select((F.col("id") * 2654435761 % (1 << 30)).alias("fp")).distinct()
    found = simhash.near_links(fps, shard_nodes=1024)
    spread = found.groupBy(F.spark_partition_id()).count().count()
    assert spread >= spark.sparkContext.defaultParallelism // 2


def test_spread_join_keeps_all_rows(spark):
    rows = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("m")).filter("k % 2 = 0")
    got = join_spread(rows, table, ["k"], 5000, one_task=0)
    assert sorted((r.k, r.id, r.m) for r in got.collect()) == sorted((r.k, r.id, r.m) for r in rows.join(table, "k").collect())
