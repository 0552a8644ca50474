"""SimHash and embedding near-dedup against brute force."""

import math

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from packetloom.llm import embeddings, simhash
from packetloom.llm.common import components, table
from tests.conftest import SF

DOCS = "doc_id long, text string"


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b])


def groups(names, linked):
    """Smallest reachable name per name, by brute force."""
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in names}


def as_components(rows):
    """doc_id -> smallest id of its component, from rows (doc_id, fingerprint)."""
    prints = sorted({f for _, f in rows})
    near = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 4]
    of = groups(prints, near)
    ids: dict = {}
    for doc, f in rows:
        if doc is not None:
            ids[of[f]] = min(ids.get(of[f], doc), doc)
    return sorted(((doc, f"{f:016x}", ids.get(of[f])) for doc, f in rows), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbé \t", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == slow_fingerprint(text)


def test_bk_forest_finds_all():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = np.array([c ^ np.uint64(1 << int(b)) ^ np.uint64(1 << int(a)) for c in centres for a, b in rng.integers(0, 64, (30, 2))])
    tree = np.repeat([0, 1, 2], 60)
    forest = simhash.Forest(values, tree)
    q, node = forest.within(values, tree, 4)
    want = {(i, j) for i in range(180) for j in range(180) if tree[i] == tree[j] and int(values[i] ^ values[j]).bit_count() <= 4}
    assert set(zip(q.tolist(), node.tolist())) == want and len(q) == len(want)


@pytest.mark.parametrize("nodes", [10, 10**6, 10**8, 10**12])
def test_some_choice_of_blocks_agrees(nodes):
    masks = simhash.block_choices(nodes)
    rng = np.random.default_rng(nodes % 97)
    for _ in range(200):
        bits = rng.choice(64, 4, replace=False)
        differ = sum(1 << int(b) for b in bits)
        assert any(m & differ == 0 for m in masks)


@pytest.mark.parametrize("shard_nodes", [1024, 8])
def test_simhash_components(spark, shard_nodes):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(i, f"{base} {i % 7} {'x' * (i % 3)}") for i in range(40)] + [(100 + i, base) for i in range(60)]
    rows += [(None, base), (None, "quite another text of some more words"), (7, None), (8, "  "), (9, "\n"), (200, "a " * 5000)] + [rows[0]] * 3
    got = simhash.simhash_components(spark.createDataFrame(rows, DOCS), shard_nodes=shard_nodes).collect()
    assert sorted(map(tuple, got), key=repr) == as_components([(d, simhash.fingerprint(t) % 2**64) for d, t in rows])


def test_simhash_on_the_smallest_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, simhash.fingerprint(r.text) % 2**64) for r in docs.collect()]
    assert sorted(map(tuple, simhash.simhash_components(docs).collect()), key=repr) == as_components(rows)


def test_keep_one_each(spark):
    rows = [(3, "a b c d e", 1), (5, "a b c d e", 2), (5, "other words are here now", 2), (9, "", 0), (None, "", 4), (9, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    got = sorted(map(tuple, simhash.keep_one_each(docs).collect()), key=repr)
    assert got == sorted([(3, "a b c d e", 1), (5, "other words are here now", 2), (9, "", 0), (None, "", 4)], key=repr)
    empty = simhash.keep_one_each(docs.filter("false"))
    assert empty.columns == docs.columns and empty.count() == 0


def test_components(spark):
    rng = np.random.default_rng(5)
    chain = [(i, i + 1) for i in range(50)]
    pairs = chain + [(int(a), int(b)) for a, b in rng.integers(100, 200, (70, 2))] + [(300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "test").collect()}
    want = groups(sorted({x for p in pairs for x in p}), pairs)
    assert all(got.get(n, n) == r for n, r in want.items())


def slow_vectors(rows, cosine):
    ok = [
        i for i, (_, v) in enumerate(rows)
        if v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    unit = {i: np.array(rows[i][1], dtype=np.float32).astype(float) for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    near = [(i, j) for i in ok for j in ok if i < j and unit[i] @ unit[j] >= cosine]
    of = groups(range(len(rows)), near)
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if of[j] == of[i] and rows[j][0] is not None]
        lowest = min(ids, default=None)
        out.append((name, sum(i in p for p in near), lowest, name is not None and name == lowest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [512, 7])
def test_near_vectors(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = [(i, [float(x) for x in np.float32(centres[i % 12] + rng.normal(scale=0.02, size=8))]) for i in range(60)]
    rows += [(100 + i, rows[5][1]) for i in range(20)]
    rows += [(900, None), (901, [0.0] * 8), (902, [None] + [1.0] * 7), (903, [float("nan")] * 8), (904, [float("inf")] + [1.0] * 7)]
    rows += [(905, [1.0, 2.0]), (906, []), (None, rows[1][1]), rows[2], rows[2]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("vec_id", "vec_id")
    got = embeddings.near_vectors(df, recall=0.9999, block=block).collect()
    assert sorted(map(tuple, got), key=repr) == slow_vectors(rows, embeddings.COSINE)


def test_vector_recall(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(300, 64))
    vectors = np.repeat(centres, 4, axis=0) + rng.normal(scale=0.2, size=(1200, 64))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.float32(vectors))]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    unit = np.float32(vectors).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    true = (unit @ unit.T >= embeddings.COSINE).sum(axis=1) - 1
    found = np.array([r.n_links for r in sorted(got)])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum() > 100


def test_no_vectors(spark):
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embeddings.near_vectors(none).collect()] == [(1, 0, 1, True)]
    assert embeddings.near_vectors(none.filter("false")).count() == 0
