"""Chat formatting, sharding, packing and the pipeline: exact round trips, laws, and brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from packetloom.llm import chat, decontamination, packing, quality, sharding, simhash
from packetloom.llm.common import sums_before, table
from packetloom.llm.queries import QUERIES
from tests.conftest import SF

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
HARD = st.text(alphabet="a\\#</turn>: ht\ncé", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HARD | st.sampled_from(["user", "assistant"]), HARD), max_size=5))
def test_chat_round_trip(turns):
    text, starts, ends = chat.format_turns(turns)
    assert chat.read_back(text) == turns
    assert [chat.unescape(text[i:j]) for i, j in zip(starts, ends)] == [t for role, t in turns if role == "assistant"]


def slow_digest(turns):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    loss = "".join(t or "" for role, t in turns if role == "assistant")
    return len(turns), sha("".join(f"{role or ''}\n{t or ''}\n" for role, t in turns)), len(loss), sha(loss)


def test_chat_query(spark):
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op5_chat_format"](spark, SF).collect()}
    turns = defaultdict(list)
    for r in table(spark, SF, "conversations").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role, r.text))
    turns[-7] = [(role, "\\### Assistant: </turn> ok") for role in ("user", "assistant")]
    assert got == {c: slow_digest(t) for c, t in turns.items()}


def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 3, "user", "more", None),
        (1, 5, 2, "user", "low", 0.5), (2, 1, 99, "user", "orphan", 0.0), (2, 2, 1, None, None, 0.0), (2, 3, 1, "assistant", "tie", 0.0),
        (None, 1, None, "assistant", "alone", 0.0), (3, 1, 2, "user", "circle", 0.0), (3, 2, 1, "user", "circle", 0.0),
        *[(4, i, i - 1 if i > 1 else None, "user", f"t{i}", 0.0) for i in range(1, 101)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, msg_id long, parent_id long, role string, text string, score double")
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_trees(df).collect()}
    assert got == {
        1: [("user", "q"), ("assistant", "good"), ("user", "more")], 2: [("user", "orphan"), ("", "")], None: [("assistant", "alone")],
        4: [("user", f"t{i}") for i in range(1, 101)],
    }
    assert chat.format_trees(df.filter("false")).count() == 0


def test_odd_turns(spark):
    rows = [(5, 1, "user", None), (5, 0, None, ""), (5, 1, "user", None), (5, None, "assistant", "first"), (None, 0, "assistant", "x" * 100000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "9 AS depth", "1 AS msg_id")
    got = {r.conv_id: chat.read_back(r.formatted) for r in chat.format_trees(chat.linear_messages(df)).collect()}
    assert got == {5: [("assistant", "first"), ("", ""), ("user", ""), ("user", "")], None: [("assistant", "x" * 100000)]}


def shard_laws(rows, shards=16):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return [sum(r.size for r in by[k]) for k in range(shards)]


def test_shards_of_equal_size(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = sharding.shard_documents(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    sizes = shard_laws(rows)
    largest = max(r.size for r in rows)
    assert max(sizes) - min(sizes) <= 2 * largest + 0.2 * sum(sizes) / 16
    at = defaultdict(set)
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        at[texts[r.doc_id]].add(r.shard)
    weight = defaultdict(int)
    for r in rows:
        weight[texts[r.doc_id]] += r.size
    assert all(len(s) == 1 for t, s in at.items() if weight[t] <= 0.1 * sum(sizes) / 16)


def test_shards_with_a_hot_group_and_odd_rows(spark):
    rows = [(i, f"text number {i} " * (1 + i % 5), "en", f"s{i % 3}") for i in range(3000)]
    rows += [(10_000 + i, "the same text for all of these", None, "hot") for i in range(2000)]
    rows += [(None, None, None, None), (1, None, None, None), (1, None, None, None), (2, "", "en", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "7 AS shard", "8 AS size", "9 AS d0")
    got = sharding.shard_documents(df).collect()
    sizes = shard_laws(got)
    assert len(got) == len(rows) and max(sizes) <= 1.03 * min(sizes)
    assert sharding.shard_documents(df.filter("false")).count() == 0
    assert [r.slot for r in sharding.shard_documents(df.limit(1)).collect()] == [0]


def test_sums_before(spark):
    rows = [(k, i, i % 7 + 1) for k in ("a", None) for i in range(0, 500, 3)]
    got = sums_before(spark.createDataFrame(rows, "k string, i long, v long"), ["k"], "i", "v", "s", step=20).collect()
    assert len(got) == len(rows) and all(r.s == sum(v for k, i, v in rows if k == r.k and i < r.i) for r in got)


ODD_TEXTS = [
    "İstanbul ΑΣ Σ ﬁ é \x1c a\x1cb <|endoftext|>x it's 'sing ''s don't'll 12ab34 ½ x y", "", None, "ŉ ſ ß ẞ ×÷ a×b", "a" * 5000,
    "%%%'re###'", "été ÉTÉ's", "<|startoftext|>", "日本語テキスト 한국어 \U0001f600\U0001f600x", "a " * 20000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aA'sé1%|<> \n", max_size=40))
def test_words_have_the_ids_of_texts(text):
    global _words
    try:
        own = _words
    except NameError:
        own = _words = packing.WordIds(open(VOCABULARY).read())
    got = np.frombuffer(own.ids([text])[0], dtype=own.kind).tolist()
    assert got == own.tokenizer.encode(text, add_special_tokens=False).ids + [2]


def check_packing(rows, docs, tokenizer, window=4096):
    """Every id of every document once, pieces gapless, windows full but the last."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    expected = defaultdict(list)
    for doc, text in docs:
        expected[doc].append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4"))
    assert set(pieces) == set(expected)
    for doc, texts in expected.items():
        want = sorted((len(t), p.start, zlib.crc32(t[p.start : p.start + p.length].tobytes())) for t in texts for p in pieces[doc] if p.doc_tokens == len(t))
        assert sum(p.length for p in pieces[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            assert sorted((p.doc_tokens, p.start, p.ids_crc32) for p in pieces[doc]) == want
            at = sorted((p.start, p.length) for p in pieces[doc])
            assert [s for s, _ in at] == np.cumsum([0, *[n for _, n in at]])[:-1].tolist()
    for k, own in places.items():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        assert k == max(places) or sum(n for _, n in own) == window
    assert set(places) == set(range(len(places)))


@pytest.mark.parametrize("bucket_bytes", [packing.BUCKET_BYTES, 20_000])
def test_packing(spark, tokenizer, bucket_bytes):
    docs = table(spark, SF, "documents").select("doc_id", "text", "source")
    odd = spark.createDataFrame([(10**6 + i, t, None if i % 2 else "src0") for i, t in enumerate(ODD_TEXTS)], docs.schema)
    both = docs.unionByName(odd).selectExpr("*", "1 AS bucket", "2 AS length", "'x' AS ids")
    rows = packing.pack(both, VOCABULARY, bucket_bytes=bucket_bytes).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in both.collect()], tokenizer)


def test_packing_of_repeated_and_no_rows(spark, tokenizer):
    docs = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", None)], "doc_id long, text string, source string")
    rows = packing.pack(docs, VOCABULARY, window=4, with_ids=True).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, window=4)
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(docs.filter("false"), VOCABULARY).count() == 0


def test_windows_follow_the_shares(spark):
    rows = [(i, "word " * 30, "abc"[0 if i % 6 < 3 else 1 if i % 6 < 5 else 2]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}
    got = packing.pack(docs, VOCABULARY, window=1024).collect()
    filled = defaultdict(lambda: defaultdict(int))
    for r in got:
        filled[r.sequence_id // 8][source[r.doc_id]] += r.length
    for k, own in filled.items():
        if k != max(filled):
            assert all(abs(own[s] / (8 * 1024) - share) < 0.06 for s, share in (("a", 1 / 2), ("b", 1 / 3), ("c", 1 / 6)))


def test_given_shares_hold_over_several_buckets(spark):
    """Until a source ends, no window is further from the target than a turn of the queues and a document."""
    rows = [(i, "word " * 30, None if i % 10 == 0 else "a" if i % 10 < 6 else "c") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}
    shares = {None: 0.5, "a": 0.25, "c": 0.25}
    for bucket_bytes in (packing.BUCKET_BYTES, 60_000):
        got = packing.pack(docs, VOCABULARY, window=1024, bucket_bytes=bucket_bytes, shares=shares).collect()
        sent, most = dict.fromkeys(shares, 0), {s: 31 * sum(own == s for own in source.values()) for s in shares}
        for n, r in enumerate(sorted(got, key=lambda r: (r.sequence_id, r.offset))):
            sent[source[r.doc_id]] += r.length
            if sent[None] < most[None]:
                assert all(abs(sent[s] - share * sum(sent.values())) < 600 for s, share in shares.items())
        assert sent == most


def test_many_small_sources_are_spread_over_buckets(spark, tokenizer):
    docs = spark.createDataFrame([(i, "word " * 30, f"s{i}") for i in range(600)], "doc_id long, text string, source string")
    rows = packing.pack(docs, VOCABULARY, window=256, bucket_bytes=9_000).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, window=256)


def test_round_robin_carries_deficits():
    queues = {"a": [10] * 50, "b": [25] * 20}
    order = packing.round_robin(queues, {"a": 0.5, "b": 0.5}, {"a": 0.0, "b": 0.0}, 20)
    sent = {"a": 0, "b": 0}
    for source, i in order:
        sent[source] += queues[source][i]
        assert abs(sent["a"] - sent["b"]) <= 45
    assert len(order) == 70
    behind = packing.round_robin(queues, {"a": 0.5, "b": 0.5}, {"a": -100.0, "b": 100.0}, 20)
    assert [s for s, _ in behind[:8]] == ["b"] * 8
    assert packing.round_robin({"x": [10**9]}, {"x": 1e-9}, {"x": 0.0}, 4096) == [("x", 0)]


def test_pipeline(spark, tokenizer):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in quality.score_documents(docs, table(spark, SF, "labels")).collect() if r.kept}
    first = corpus_pipeline.reject_bad(spark, docs, SF)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == kept
    of = {r.doc_id: r.component_id for r in simhash.simhash_components(docs.filter(docs.doc_id.isin(list(kept)))).collect()}
    single = {d for d, c in of.items() if d == c}
    second = corpus_pipeline.drop_near_copies(spark, first, SF)
    assert second.columns == docs.columns and {r.doc_id for r in second.collect()} == single
    hit = {r.doc_id for r in decontamination.contamination(docs, table(spark, SF, "benchmark")).collect() if r.contaminated}
    third = corpus_pipeline.drop_contaminated(spark, second, SF)
    assert third.columns == docs.columns and {r.doc_id for r in third.collect()} == single - hit
    check_packing(corpus_pipeline.run(spark, SF).collect(), [(d, texts[d]) for d in single - hit], tokenizer)


def test_stages_on_odd_rows(spark):
    docs = table(spark, SF, "documents")
    odd = [(None, None, None, None, None), (-1, "", "", "", 0), (-1, "", "", "", 0), (-2, "w " * 30000, "en", None, 1)]
    wide = docs.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "1 AS bucket", "'y' AS text_hash", "2 AS _kept")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, SF)
        out.count()
        assert stage(spark, wide.filter("false"), SF).count() == 0
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == wide.columns
