"""Parts of new words are looked up once each in their store, and words keep their own ids."""

import public_tokenizers

from packetloom.llm import packing
from tests.llm.test_word_store import Counting


def test_parts_of_new_words_are_looked_up_once():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    texts = ["One word, don't 'tis x1y22 two", None, "Straße ÀÉ !'s we're 's 't", "<|odd|> words 中文 a\x1cb two", "w" * 70 + " " + "q7" * 40]
    texts += [" ".join(f"{chr(97 + i % 26)}new{i},{i}" for i in range(250))]  # some groups of words hold others than plain ones, some do not
    plain = [list(e.ids) + [packing.END_ID] for e in packing.Tokenizer.from_str(vocabulary).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    own = packing.WordIds(vocabulary)
    own.parts = Counting(own.parts)
    Counting.looks = 0
    assert [packing.np.frombuffer(i, own.kind).tolist() for i in own.ids(texts)] == plain
    new = {w for t in texts for w in (t or "").split(" ")} - {"<|odd|>", "中文", "a\x1cb", ""}
    assert Counting.looks == len(own.PARTS.findall(" ".join(new).lower()))


def test_the_largest_number_is_no_id():
    assert [packing.id_kind('{"model": {"vocab": {"a": %d}}}' % n) for n in (65534, 65535)] == ["<u2", "<u4"]
