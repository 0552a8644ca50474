"""Words of texts are looked up once each in the store of ids."""

import public_tokenizers

from packetloom.llm import packing


class Counting(dict):
    looks = 0

    def get(self, key, default=None):
        Counting.looks += 1
        return super().get(key, default)

    def __contains__(self, key):
        Counting.looks += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        Counting.looks += 1
        return super().__getitem__(key)


def test_known_words_are_looked_up_once(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    texts = ["One word, two words; Straße x1y22 two", None, "", "  ", "two <|odd|> words 中文 don't", "w" * 70 + " two"]
    plain = [list(e.ids) + [packing.END_ID] for e in packing.Tokenizer.from_str(vocabulary).encode_batch([t or "" for t in texts], add_special_tokens=False)]

    def read(own):
        return [packing.np.frombuffer(i, own.kind).tolist() for i in own.ids(texts)]

    own = packing.WordIds(vocabulary)
    own.words = Counting()
    assert read(own) == plain  # learning on the way
    Counting.looks = 0
    assert read(own) == plain
    assert Counting.looks == sum(len((t or "").split()) for t in texts)
    monkeypatch.setattr(packing, "_CACHE_WORDS", 0)
    full = packing.WordIds(vocabulary)
    assert read(full) == plain and not full.words
