"""What the encoding of words asks of the tokenizer library."""
import random

from csvforge.llm import tokens as T

V = T.VOCABULARY


def test_plain_words_skip_the_normalizer(monkeypatch):
    encode, sent = T.load(V), []
    words = [f"Wort{'abcdefghij'[i % 10] * (i // 10 % 30 + 1)}É, it's {i}" for i in range(600)]
    want = encode(words)
    T.boundary_of(V), T.separator(V)
    monkeypatch.setitem(T._LOADED, V, lambda texts: (sent.extend(texts), encode(texts))[1])
    T._TABLES.clear()
    assert [a.tolist() for a in T.encode_words(words, V)] == want
    assert not sent
    assert [a.tolist() for a in T.encode_words(["one <|endoftext|> two"], V)] == encode(["one <|endoftext|> two"])
    assert sent


def test_words_by_piece_equal_whole_texts():
    rnd = random.Random(5)
    letters = "abcXYZ'stremvldÀÖßàÿé×÷0129.,!?<|>́İΣ²½ \n\t\x1c\x85 中한ŉ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["", "I'LL 'S we're <|EndOfText|>", "x<|endoftext|>y", "<|startoftext|>", "a" * 3000, "É" * 500, "É é"]
    T._TABLES.clear()
    assert [a.tolist() for a in T.encode_words(texts, V)] == T.load(V)(texts)
