"""Operator 13 against the library on whole texts."""

import os
import random

import public_tokenizers
import pytest
import tokenizers

from runscope.llm import token_counts as tc

PARTS = [
    "a", "b", "Z", "1", "23", " ", "  ", "\n", "\t", "  ", "　", "'s", "'ll", "'", "<|endoftext|>", "<|", "|>", "endoftext",
    ".", ",", "。", "漢", "字", "ア", "・", "é", "я", "²", "Ⅷ", "\x1c", "​", "🙂", "!", "!!", "\r\n", "é",
]


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(tc.TOKENIZER))


def counted(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_pieces_have_the_tokens_of_the_text(library):
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(70)))
        parts = list(tc.pieces(text, rng.randrange(1, 6)))
        assert "".join(parts) == text
        assert sum(counted(library, p) for p in parts) == counted(library, text)


def test_words_have_the_tokens_of_the_text_and_are_encoded_once(library):
    rng, asked = random.Random(3), []

    def encode(parts, add_special_tokens):
        asked.extend(parts)
        return library.encode_batch_fast(parts, add_special_tokens=add_special_tokens)

    known = tc.WordCounts(encode)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(70))) for _ in range(4000)]
    assert list(known.of_texts(texts, 50, 2_000)) == [counted(library, t) for t in texts]
    before = len(asked)
    assert list(known.of_texts(texts[:100], 50, 2_000)) == [counted(library, t) for t in texts[:100]] and len(asked) == before
    small = tc.WordCounts(encode, kept=10)
    assert [n for t in texts[:300] for n in small.of_texts([t], 50, 2_000)] == [counted(library, t) for t in texts[:300]] and len(small) < 70


def test_batches_have_a_bounded_size_and_lose_nothing():
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) + " x" for _ in range(rng.randrange(400))) for _ in range(50)]
    back = [""] * len(texts)
    for owners, parts in tc._batches(texts, 100, 1000):
        assert sum(map(len, parts)) < 1000 + 300
        for owner, part in zip(owners, parts):
            back[owner] += part
    assert back == texts


def test_counts(spark, frame, odd_rows, library):
    rows = odd_rows + [(20, "<|endoftext|>"), (21, "x" * 20_000), (22, "字" * 9_000 + "。" + "ア" * 30_000), (23, "a <|endoftext|> b " * 3_000)]
    got = tc.count_tokens(frame(rows), tc.tokenizer_file(spark), limit=100, piece=50, batch=2_000).collect()
    want = []
    for i, text in rows:
        n = counted(library, text or "")
        want.append((i, len((text or "").encode()), n, n > 100))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert tc.count_tokens(frame([]), tc.tokenizer_file(spark)).collect() == []
