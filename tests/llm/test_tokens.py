"""The encoder's short cuts against the tokenizers library."""

import os
import random

import pytest

PATHS = ("byte_bpe_50k.json", "word_bpe_49k.json")
PARTS = ["a", "The", "of", "über", "naïve", "É", "x1", "12", ",", ".", "'s", "don't", "...", "\0", "\0b", "b\0", "\n", "\t", "\u00a0", "\u2003", "e\u0301",
         "\u0301", "日本", "日本語", "<|endoftext|>", "<|im_start|>", "ﬁ", "ß", "İ", "\u200d", "😀", "a-b", "(x)", "_", "Ω", "\ud7ff", "", " ", "  "]


@pytest.mark.parametrize("name", PATHS)
def test_encoder_equals_the_library(name, monkeypatch):
    import public_tokenizers

    from offerline.llm import tokens

    if not os.path.exists(public_tokenizers.path(name)):
        pytest.skip("no tokenizer")
    rnd = random.Random(7)
    texts = ["", " ", "\0", "a \0b", "\0 a", "a \0", " \0", "\0a b", "x \0\0 y", "b b \0b b"]
    texts += [rnd.choice([" ", "", " "]).join(rnd.choices(PARTS, k=rnd.randint(1, 12))) for _ in range(4000)]
    texts += ["".join(rnd.choices(PARTS, k=3000)), " ".join(rnd.choices(PARTS[:8], k=50_000))]
    encoder = tokens.Encoder(public_tokenizers.path(name))
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    monkeypatch.setattr(tokens, "TEXT_AT_ONCE", 200)        # many slices, and memos that start anew
    monkeypatch.setattr(tokens, "MEMO_WORDS", 50)
    monkeypatch.setattr(tokens, "MEMO_PIECES", 40)
    assert [x.tolist() for x in encoder.encode(texts)] == want
    rnd.shuffle(both := list(zip(texts, want)))
    assert [x.tolist() for x in encoder.encode([t for t, _ in both])] == [w for _, w in both]


def test_a_column_is_encoded_some_texts_at_once(monkeypatch):
    """The pipeline's last stage ran out of an executor's memory: a whole
    batch stood as strings and ids before its first row was given out."""
    import public_tokenizers
    import pyarrow as pa

    from offerline.llm import tokens

    if not os.path.exists(public_tokenizers.path(PATHS[0])):
        pytest.skip("no tokenizer")
    monkeypatch.setattr(tokens, "TEXT_AT_ONCE", 100)
    encoder = tokens.Encoder(public_tokenizers.path(PATHS[0]))
    texts = ["", "x" * 60, "é " * 30, "a b " * 100, "", "y"] * 10
    want, sizes, encode = encoder.encode(texts), [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda part: sizes.append(sum(map(len, part))) or encode(part))
    ids = encoder.encode_column(pa.array(["other", *texts]).slice(1))
    got = [next(ids)]
    assert len(sizes) == 1
    got += ids
    assert max(sizes) == 400 and all(n <= 100 or n == 400 for n in sizes)     # a longer text alone
    assert [x.tolist() for x in got] == [x.tolist() for x in want]
    assert list(encoder.encode_column(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("name", PATHS)
def test_words_at_the_length_of_a_row(name):
    """Words just as long as a row of the array of words, longer ones, ones
    that differ in NUL characters only, and marks behind any of them."""
    import public_tokenizers

    from offerline.llm import tokens

    if not os.path.exists(public_tokenizers.path(name)):
        pytest.skip("no tokenizer")
    rnd = random.Random(3)
    words = [x * n + y for x in ("a", "é", "Ab", "ÿ") for n in range(1, 30) for y in ("", "É", ".", "...", "_-", "'s", "\0", "\0\0", "x.y", "É!", "\n")]
    words += ["".join(rnd.choices("abcdeé", k=rnd.randint(1, 26))) + rnd.choice(["", ",", "!?"]) for _ in range(20_000)]
    texts = [" ".join(rnd.sample([w for w in words if nul or "\0" not in w], 200)) for nul in [True, False, False, False] * 50]
    encoder = tokens.Encoder(public_tokenizers.path(name))
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode(texts)] == want
    assert [x.tolist() for x in encoder.encode(texts[::-1])] == want[::-1]
    assert encoder.encode([]) == []


def test_a_known_word_takes_few_bytes():
    """Every word stood as a Python string in a dict, 200 bytes and more each:
    two workers kept some hundred MB of an executor's memory."""
    import tracemalloc

    import public_tokenizers

    from offerline.llm import tokens

    if not os.path.exists(public_tokenizers.path(PATHS[0])):
        pytest.skip("no tokenizer")
    rnd = random.Random(5)
    words = list({"".join(rnd.choices("abcdefghij", k=10)) for _ in range(150_000)})
    texts = [" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)]
    encoder = tokens.Encoder(public_tokenizers.path(PATHS[0]))
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for text in texts:
            encoder.encode([text])
        kept = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert kept < 130 * len(words)


def test_the_most_used_words_are_kept(monkeypatch):
    """All words were forgotten once more than half of the limit were in use
    more than once."""
    import public_tokenizers

    from offerline.llm import tokens

    if not os.path.exists(public_tokenizers.path(PATHS[0])):
        pytest.skip("no tokenizer")
    monkeypatch.setattr(tokens, "MEMO_WORDS", 40)
    encoder = tokens.Encoder(public_tokenizers.path(PATHS[0]))
    rare, often = [f"rare{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(10)], ["most", "used"]
    encoder.encode([" ".join(["x", *(rare + often * 3) * 2])])
    learned, letters = [], encoder.letters
    monkeypatch.setattr(encoder, "letters", lambda plain: learned.extend(plain) or letters(plain))
    encoder.encode(["x most used"])
    assert learned == []
