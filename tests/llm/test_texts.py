"""License scan, decontamination, language model, classifier and page texts against brute force and on odd rows."""

import hashlib
import html
import math
import re
import string
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from packetloom.llm import decontamination, gru, licenses, lm, pages, quality
from packetloom.llm.common import table
from packetloom.llm.oracle import ORACLE
from tests.conftest import SF

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (None, "The MIT License; mit license"), (4, "General  Public-LICENSE é É apache license"),
    (5, "x " * 20000 + "mit license"), (6, "mit license"), (6, "mit license"), (7, "İé MIT\x00LICENSE ½ 日本"),
    (8, "Redistribution and use in source and, maybe, binary forms, with or without modification, are permitted provided that conditions are met"),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def odd_docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ODD], "doc_id long, text string, words string, pos int")


def slow_scan(rows):
    out = []
    for doc, text in rows:
        w, at, labels = words(text), [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        out.append((doc, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    return sorted(out, key=repr)


def test_license_scan(spark):
    base = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    for df in (odd_docs(spark), table(spark, SF, "documents")):
        got = licenses.scan(df).collect()
        assert sorted((tuple(r[c] for c in base) for r in got), key=repr) == slow_scan([(r.doc_id, r.text) for r in df.collect()])
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert {r.labels for r in licenses.scan(odd_docs(spark)).collect() if r.doc_id == 8} == {"bsd"}
    assert licenses.scan(odd_docs(spark).filter("false")).count() == 0


@pytest.mark.parametrize("label", sorted(licenses.TEXTS))
def test_templates_survive_edits(spark, label):
    text = licenses.TEXTS[label][0].split()
    if len(text) > 14:
        text = text[:6] + ["really"] + text[6:12] + text[13:]
    df = spark.createDataFrame([(1, "before it " + " ".join(text) + " and after")], "doc_id long, text string")
    assert label in licenses.scan(df).first().labels.split(",")


def test_stray_pairs_do_not_hide_a_template(spark):
    isc = licenses.TEXTS["isc"][0].split()
    edited = " ".join(isc[:9] + ["really"] + isc[9:20] + isc[21:])
    rows = [
        (1, "Code licensed under MIT, text licensed under CC BY-NC 4.0"), (2, "licensed under x " * 300 + "licensed under CC BY-NC 4.0 " + "y licensed under " * 300),
        (3, "permission notice or fee this software " * 20 + edited + " and this software without fee" * 20), (4, "licensed under x " * 300 + "by z nc q 4.0"),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.labels, r.score) for r in found.collect()}
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cols = ", ".join(found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(duck.execute(f"SELECT {cols} FROM ({ORACLE['op3_license_scan']})").fetchall())
    assert got[1] == got[2] == ("cc-by-nc", 1.0) and got[3][0] == "isc" and 0.75 <= got[3][1] < 1 and got[4] == ("", 0.0)


def slow_contamination(docs, items, size):
    windows: dict = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for window, names in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= names
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        n_items = len([i for i in found if i is not None])
        out.append((doc, len(w), len(hit), n_items, hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def test_contamination(spark):
    rng = np.random.default_rng(2)
    letters = list("abc")
    docs = [(i, " ".join(rng.choice(letters, int(n)))) for i, n in enumerate(rng.integers(0, 60, 30))] + ODD
    items = [(i, " ".join(rng.choice(letters, int(n)))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 9, 12])]
    items += [(90, None), (91, " "), (92, "mit LICENSE"), (93, "mit license"), (None, "x x x x"), (94, "not there at all")]
    got = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=5
    )
    assert sorted(map(tuple, got.collect()), key=repr) == slow_contamination(docs, items, 5)


def test_contamination_on_the_smallest_table(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = slow_contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    assert sorted(map(tuple, decontamination.contamination(docs, items).collect()), key=repr) == want
    clean = decontamination.keep_clean(docs, items)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in want if not r[5])


def test_contamination_without_rows(spark):
    docs, none = odd_docs(spark), spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontamination.contamination(docs, none).collect())
    assert decontamination.keep_clean(docs, none).count() == len(ODD)
    assert decontamination.contamination(docs.filter("false"), table(spark, SF, "benchmark")).count() == 0


def slow_base(rows):
    texts = [(doc, (t or "").encode().lower().split() + [b"\n"]) for doc, t in rows]
    out_of = [doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1 for doc, _ in texts]
    counts = Counter(w for (_, t), out in zip(texts, out_of) if not out for w in t)
    total, distinct = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t) for _, t in texts]
    return sorted(
        ((doc, out, len(t), sum(counts[w] > 0 for w in t), total, round(b, 5)) for (doc, t), out, b in zip(texts, out_of, base)), key=repr
    )


@pytest.mark.parametrize("warm", [lm.WARM, 30])
def test_language_model_base(spark, warm, monkeypatch):
    monkeypatch.setattr(lm, "WARM", warm)
    for df in (odd_docs(spark), table(spark, SF, "documents")):
        got = lm.score_documents(df).collect()
        shown = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
        assert sorted(((*[r[c] for c in shown], round(r.base_score, 5)) for r in got), key=repr) == slow_base([(r.doc_id, r.text) for r in df.collect()])
        assert all(r.score < 0 for r in got)
    assert lm.score_documents(df.filter("false")).count() == 0


def test_untrained_network_is_the_unigram_model():
    shape = gru.Shape(40, 3)
    counts, rare = np.arange(40, 0, -1) * 1e4, np.array([5e4, 2e4, 5e3])
    values = gru.start_values(shape, counts, rare)
    shape.views(values)["wc"][:] = 0
    shape.views(values)["ww"][:] = 0
    docs = [np.array([0, 5, 41, 39], dtype=np.int32), np.array([2], dtype=np.int32)]
    share = np.log10(np.concatenate([counts, rare]) / (counts.sum() + rare.sum()))
    assert np.allclose(gru.score(values, shape, docs), [share[d].sum() for d in docs], atol=0.02)


def test_state_is_carried_across_windows_and_lanes_do_not_matter():
    shape = gru.Shape(40, 3)
    values = gru.start_values(shape, np.ones(40), np.ones(3)) * 3
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 43, n).astype(np.int32) for n in (200, 3, 70, 1, 33)]
    whole = gru.score(values, shape, docs)
    assert np.allclose(whole, [gru.score(values, shape, [d])[0] for d in docs], rtol=1e-4)
    assert np.allclose(whole, gru.score(values, shape, docs, width=2), rtol=1e-4)
    assert abs(whole[0] - sum(gru.score(values, shape, [docs[0][i : i + 32]])[0] for i in range(0, 200, 32))) > 1e-3


def test_gradients_against_differences():
    shape = gru.Shape(40, 3)
    values = gru.start_values(shape, np.ones(40), np.ones(3)).astype(np.float64) * 2
    docs = [np.array([0, 3, 41, 5, 1, 39], dtype=np.int32), np.array([2, 42], dtype=np.int32)]
    (x, y, _, first), = gru.Lanes(docs, 8, 43).windows()
    loss = lambda flat: -gru.score(flat.astype(np.float32), shape, docs).sum() * np.log(10)
    grad = np.zeros(shape.size, dtype=np.float32)
    p, g = shape.views(values.astype(np.float32)), shape.views(grad)
    used, rows, _ = gru.gradient(p, g, shape, x, y, first, np.zeros((2, gru.HIDDEN), np.float32), np.float32(1))
    g["wx"][used] = rows
    rng = np.random.default_rng(2)
    for at in [*np.argsort(-np.abs(grad))[:40], *rng.integers(0, shape.size, 40)]:
        step = np.zeros_like(values)
        step[at] = 0.02
        assert abs((loss(values + step) - loss(values - step)) / 0.04 - grad[at]) < 0.02 + 0.02 * abs(grad[at])


def test_gradient_of_the_network():
    shape = gru.Shape(6, 2)
    values = gru.start_values(shape, np.ones(6), np.ones(2)) * 3
    docs = [np.array([0, 3, 7, 5, 1], dtype=np.int32), np.array([2, 6], dtype=np.int32)]
    trained, seen = values, None
    for _ in range(30):
        trained, seen = gru.train(trained, shape, docs, seen, rate=0.05)
    assert gru.score(trained, shape, docs).sum() > gru.score(values, shape, docs).sum() + 1


def test_language_model_beats_the_base_on_held_out_texts(spark):
    rng = np.random.default_rng(6)
    kinds = [["uno dos tres", "cuatro"], ["eins zwei", "drei vier funf"]]
    rows = [(i, " ".join(rng.choice(" ".join(kinds[i % 2]).split(), 60))) for i in range(400)]
    got = [r for r in lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)


@pytest.mark.parametrize("part", [1, 2, lm.PART - 1])
def test_every_part_trains_the_network(spark, part):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) // 5 % lm.PART == part]
    docs = spark.createDataFrame([(i, "a b a b c") for i in ids], "doc_id long, text string").coalesce(1)
    model = lm.Model([(w, lm.rare_class(w), 9) for w in (b"a", b"b", b"c", lm.END)], 36, 4, {})
    before = model.values.copy()
    assert not np.array_equal(lm.fit(docs, model), before)


def test_classifier(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    known = labels.filter("doc_id % 3 <> 0")
    truth = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in labels.filter("doc_id % 3 = 0").collect()}
    got = {r.doc_id: r for r in quality.score_documents(docs, known).collect()}
    right = [got[d].kept == good for d, good in truth.items()]
    assert len(got) == docs.count() and np.mean(right) > 0.85
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in got.items() if r.kept)


def test_classifier_on_odd_rows(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "xx", None, 0), (-2, "w " * 50000, None, "s", None), (0, "again", "en", "s", 5)], docs.schema)
    both = docs.unionByName(odd).selectExpr("*", "1 AS score", "true AS kept")
    labels = table(spark, SF, "labels")
    extra = spark.createDataFrame([(None, 1, 0), (0, 0, None), (4, None, 1), (10**9, 1, 1)], labels.schema)
    got = quality.score_documents(both, labels.unionByName(extra)).collect()
    assert len(got) == docs.count() + 4 and all(0 <= r.score <= 1 for r in got)
    none = quality.score_documents(docs, labels.filter("quality = 1 AND toxic = 0"))
    assert all(r.kept and r.score == 1 for r in none.collect())
    assert quality.keep_good(docs.filter("false"), labels).count() == 0


PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>";</script></head><body><header><h1>Site</h1></header>'
    '<nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy now</div><div class="cookie-notice">We use cookies</div>'
    "<article><header><h1>The  title &amp; more</h1></header><p><b>First\n block<br>goes on &eacute;&#x41;&am<p>Second, unclosed <i>one</i>"
    '<aside>Side bar</aside><form>Name <input value="x"><button>Send</button></form><ul><li>Item one<li>Item two</ul>'
    '<section class="comments"><p>Great article, thanks a lot to you</p></section></article><footer>&copy; all</footer></body></html>'
)


def test_page_text(spark):
    marked = table(spark, SF, "pages").select("page_id", "url", "html")
    rows = [(-1, "u", PAGE), (-2, None, None), (-3, "u", ""), (-4, "u", "just words"), (-5, "u", "<p"), (None, "u", "<div>a</div>b<br>c"), (-1, "u", PAGE)]
    pages_in = marked.unionByName(spark.createDataFrame(rows, marked.schema)).selectExpr("*", "'x' AS text", "1 AS n_chars")
    got: dict = {}
    for r in pages.extract(pages_in).collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    article = "The title & more\nFirst block goes on éA&am\nSecond, unclosed one\nItem one\nItem two"
    assert got[-1] == [article, article] and got[-2] == [""] and got[-3] == [""] and got[-4] == ["just words"] and got[-5] == [""]
    assert got[None] == ["a\nb c"]
    for r in marked.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert got[r.page_id] == ["\n".join(b for b in blocks if b)]
    assert pages.extract(pages_in.filter("false")).count() == 0


def test_pages_without_marked_articles():
    inside, outside = pages.count_names(PAGE)
    scores = pages.scores_of({n: 5 * c for n, c in inside.items()}, {n: 5 * c for n, c in outside.items()})
    page = (
        "<body><div id='menu'><ul><li><a href=x>Home</a></li></ul></div><div class='content'><h2>Title here</h2><p>Text of the page is here.</p>"
        "<div class='advert'>Buy now</div><p>And it goes on for a while.</p></div><div class=sidebar>foo bar baz</div></body>"
    )
    assert pages.main_text(page, scores) == "Title here\nText of the page is here.\nAnd it goes on for a while."
    assert pages.main_text("<a b=\"" * 3000, scores) == ""
