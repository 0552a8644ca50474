"""Line dedup, spelling variants and whitening against brute force, and their defined cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packetloom.llm import line_dedup, spelling, whitening
from packetloom.llm.common import table
from packetloom.llm.queries import QUERIES
from tests.conftest import SF

DOCS = "doc_id long, text string, r1 string, lo long"


# --- lines


def slow_lines(rows, min_docs, keep_first=False):
    keys = [[line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)}) for line in (t or "").split("\n")] for _, t in rows]
    often = Counter(k for own in keys for k in set(own) if k)
    drop = {k for k, n in often.items() if n >= min_docs}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    first = {}
    for i in order:
        for k in keys[i]:
            first.setdefault(k, i)
    out = []
    for i, (doc, text) in enumerate(rows):
        lines, kept, seen = (text or "").split("\n"), [], set()
        for line, k in zip(lines, keys[i]):
            if k not in drop or (keep_first and first[k] == i and k not in seen):
                kept.append(line)
            seen.add(k)
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def random_texts(n):
    rng = random.Random(5)
    words = ["Common line", " common LINE\t", "rare", "", "  ", "été", "ÉTÉ", "\r", "twice here", "x" * 3000]
    return [(i, "\n".join(rng.choice([*words, f"own {i}", f"some {i % 7}"]) for _ in range(rng.randrange(1, 9)))) for i in range(n)]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("max_bits", [line_dedup.MAX_BITS, line_dedup.SEGMENT_BITS])
def test_lines(spark, keep_first, max_bits):
    rows = [*random_texts(60), (60, None), (61, ""), (None, "common line\nalone")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS).repartition(5)
    got = line_dedup.dedup_lines(df, min_docs=4, keep_first=keep_first, max_bits=max_bits)
    assert sorted(map(tuple, got.collect()), key=repr) == slow_lines(rows, 4, keep_first)


def test_line_cases(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (2, "A \nc"), (3, None), (None, "a"), (4, "éé\nb")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)
    assert sorted(map(tuple, line_dedup.dedup_lines(df, min_docs=3).collect()), key=repr) == sorted(
        [(1, "", 2, 2), (1, "", 2, 2), (2, "c", 2, 1), (3, "", 1, 0), (None, "", 1, 1), (4, "éé", 2, 1)], key=repr
    )
    # one code point is too short, two of two bytes each are not
    longer = line_dedup.dedup_lines(df.unionByName(df), min_docs=2, min_chars=2)
    assert {(r.doc_id, r.text) for r in longer.collect()} == {(1, "a\nb"), (2, "A \nc"), (3, ""), (None, "a"), (4, "b")}
    assert line_dedup.dedup_lines(df.filter("false")).count() == 0
    long = spark.createDataFrame([(i, "same\n" * 100_000 + f"end {i}", "x", 1) for i in range(3)], DOCS)
    assert [r.n_dropped for r in line_dedup.dedup_lines(long, min_docs=3).collect()] == [100_000] * 3


def test_twice_seen_filter_misses_nothing(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(-(2**63), 2**63, (3000, 2))
    rows = [([int(k[0]) for k in part], [int(k[1]) for k in part]) for part in np.array_split(np.concatenate([keys, keys[:500]]), 17)]
    df = spark.createDataFrame(rows, "lo array<long>, hi array<long>").repartition(6)
    bits = line_dedup.filter_bits(3500)
    seen = line_dedup.broadcast_filter(df, bits).value
    hit = (seen[(keys & (bits - 1)) >> 3] >> (keys & 7).astype(np.uint8) & 1).all(axis=1)
    assert hit[:500].all() and hit[500:].mean() < 0.2


# --- words


def slow_variants(counts, ratio=10):
    """word -> (form, root, n, near, form_n), by deletions of one letter."""
    near = {w: set() for w in counts}
    shapes = {}
    for w in counts:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            if cut in counts:
                near[w].add(cut)
                near[cut].add(w)
            shapes.setdefault((w[:i], w[i + 1 :]), []).append(w)
    for group in shapes.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def found_variants(df, **options):
    got = spelling.group_variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("block_letters", [spelling.BLOCK_LETTERS, 60])
def test_variants_of_random_words(spark, block_letters):
    rng = random.Random(1)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7))) for _ in range(500)} | {"漢字", "漢", "x" * 500, "x" * 501}
    counts = {w: rng.choice([1, 2, 3, 20, 30, 300]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert found_variants(df, block_letters=block_letters) == slow_variants(counts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=3, max_size=3), min_size=1, max_size=8), st.lists(st.text(alphabet="abé", min_size=2, max_size=3), min_size=1, max_size=8))
def test_trie_search(held, asking):
    group = {ord(c): i for i, c in enumerate("abé")}
    a, h = spelling.near_pairs(asking, held, group, 3)

    def apart(x, y):
        if len(x) == len(y):
            return sum(i != j for i, j in zip(x, y)) == 1
        return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    want = sorted((i, j) for i, x in enumerate(asking) for j, y in enumerate(held) if apart(x, y))
    assert sorted(zip(a.tolist(), h.tolist())) == want


def test_variants_query(spark):
    counts = Counter()
    for r in table(spark, SF, "documents").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            word = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{r.doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = QUERIES["op12_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == slow_variants(counts)


def test_word_counts(spark):
    rows = [(1, "Été-Wort wort WORT Kurz", "x", 1), (1, "Été-Wort wort WORT Kurz", "x", 1), (None, None, "x", 1), (2, "", "x", 1), (3, "w" * 9000, "x", 1)]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.word: r.n for r in spelling.count_words(df, min_length=4, min_count=1).collect()}
    assert got == {"wort": 6, "kurz": 2, "w" * 9000: 1}
    assert spelling.count_words(df.filter("false")).count() == 0
    assert spelling.group_variants(spelling.count_words(df.filter("false"))).count() == 0


# --- vectors


def covariance(x):
    centred = x - x.mean(axis=0)
    return centred.T @ centred / len(x)


@pytest.mark.parametrize("case", ["random", "low rank", "repeated", "close", "one", "zero"])
def test_principal_components(case):
    rng = np.random.default_rng(4)
    turn, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    values = {
        "random": np.sort(rng.gamma(1.0, 50.0, 40))[::-1], "low rank": np.r_[np.arange(9, 0, -1) * 3.0, np.zeros(31)],
        "repeated": np.repeat([8.0, 5.0, 5.0, 1.0], 10), "close": 5 + np.arange(40)[::-1] * 1e-7, "one": np.r_[3.0, np.zeros(39)],
        "zero": np.zeros(40),
    }[case]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.principal(matrix, 32)
    wanted = values[:32][values[:32] > 0]
    assert np.allclose(found, wanted, rtol=1e-9, atol=1e-9 * (values.max() or 1))
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-12
    assert np.abs(matrix @ vectors - vectors * found).max(initial=0) <= 1e-11 * (values.max() or 1)


def test_inertia_counts():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(25, 25))
    spectrum = whitening.Spectrum(a + a.T)
    values = np.linalg.eigvalsh(a + a.T)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 50):
        assert spectrum.above(shift) == (values > shift).sum()


def slow_whitening(vectors, most=32):
    x = np.floor(64 * np.array(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    values, axes = np.linalg.eigh(covariance(x.astype(np.float64)))
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    off = x * len(x) - x.sum(axis=0)
    return np.abs((x - x.sum(axis=0) / len(x)) @ axes / np.sqrt(values)), (off**2).sum(axis=1), values / np.trace(covariance(x.astype(float)))


def test_whitening_query(spark):
    rows = sorted((r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect())
    got = QUERIES["op13_embedding_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    white, deviation, explained = slow_whitening([v for _, v in rows])
    assert got.vec_id.tolist() == np.repeat([i for i, _ in rows], 32).tolist() and got.component.tolist() == [*range(1, 33)] * len(rows)
    assert np.abs(np.abs(got.whitened.to_numpy().reshape(-1, 32)) - white).max() < 1e-6
    assert got.deviation.tolist() == np.repeat(deviation, 32).tolist() and set(got.n) == {len(rows)}
    assert np.allclose(got.explained[:32], explained, rtol=1e-9) and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9


def test_whitening_cases(spark):
    kind = "vec_id long, embedding array<float>, n string"
    rng = np.random.default_rng(3)
    plain = [(i, [float(v) for v in rng.normal(size=3)], "x") for i in range(20)]
    odd = [(50, None, "x"), (51, [], "x"), (52, [1.0, None, 2.0], "x"), (53, [1.0, float("nan"), 2.0], "x"), (54, [float("inf"), 0.0, 0.0], "x"),
           (55, [1e30, 0.0, 0.0], "x"), (60, [1.0, 2.0], "x"), (61, [1.0, 2.0], "x"), (62, [5.0], "x"), (None, plain[0][1], "x"), (0, plain[0][1], "x")]
    got = whitening.whiten(spark.createDataFrame(plain + odd, kind)).toPandas()
    # vectors of three entries only: equal pairs and single ones have no variance
    assert len(got) == 22 * 3 and set(got.n) == {22} and got.vec_id.isna().sum() == 3
    white, deviation, _ = slow_whitening([v for _, v, _ in plain] + [plain[0][1]] * 2)
    own = got[got.vec_id == 7].sort_values("component")
    assert np.abs(np.abs(own.whitened) - white[7]).max() < 1e-9 and set(own.deviation) == {deviation[7]}
    wide = spark.createDataFrame([(i, [float(v), -float(v)], "x") for i, v in enumerate([0, 1e9, 1.5e10, 3])], kind)
    far = whitening.whiten(wide).toPandas()
    assert far.component.tolist() == [1] * 4 and far.identity_error.max() < 1e-9
    x = [int(64 * np.float32(v)) for v in (0, 1e9, 1.5e10, 3)]
    exact = [2 * (4 * v - sum(x)) ** 2 for v in x]
    got = [None if np.isnan(v) else int(v) for v in far.sort_values("vec_id").deviation]
    assert [g is None for g in got] == [e >= 2**63 for e in exact] and any(g is None for g in got)
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
