import json
import random
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from caseloom.llm import bpe

SIGNS = [*" \n\t\x0b\x0c\r\x1c\x1f\x85\xa0 ​　 aZqéß日本١²Ⅷ'!?#́\U0001f600_9", "  ", "   ", "'ve", "'s", " '", "\n ", " \n", "<|endoftext|>", "ing", " the", "-----", "aaaaaaa", "x" * 50]


@pytest.fixture(scope="module")
def content():
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(bpe.default_vocabulary())
    found.no_truncation()
    found.no_padding()
    return found


def words(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(["th", "er", "ou", "é", "on", "z", "ß", "ing", "q"], k=rng.randint(2, 7))) + f"{k:x}" for k in range(n)]


def equal(texts, coded, library):
    assert len(texts) == len(coded)
    for t, got, want in zip(texts, coded, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(got, "<u4").tolist() == want.ids, repr(t)


def test_unknown_fragments_are_merged_together(content, library):
    """Each unknown fragment took dozens of calls, three for each of its merges."""
    mine, text, calls = bpe.ByteBpe(content), " ".join(words(20_000)), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        coded = mine.encode(text)
    finally:
        sys.setprofile(None)
    assert calls < 20_000
    equal([text], [coded], library)


@pytest.mark.parametrize("block, unknown, segments, remembered", [(1 << 16, 1 << 18, 8192, 120_000), (7, 20, 3, 5), (1, 1, 1, 1), (50, 1 << 18, 8192, 40)])
def test_all_texts_equal_library(content, library, monkeypatch, block, unknown, segments, remembered):
    for name, value in (("BLOCK", block), ("UNKNOWN", unknown), ("SEGMENTS", segments), ("REMEMBERED", remembered)):
        monkeypatch.setattr(bpe, name, value)
    mine, rng = bpe.ByteBpe(content), random.Random(block)
    texts = ["", *("".join(rng.choices(SIGNS, k=rng.randint(0, 30))) for _ in range(1500)), " ".join(words(300, 2)), "", "ab" * 300 + "日本" * 100, " a1é." * 200, "a1é.日\n" * 200, " " * 200]
    coded = list(mine.encode_all(iter(texts)))
    equal(texts, coded, library)
    assert coded == [mine.encode(t) for t in texts]
    assert len(mine.memo) <= max(remembered, block + unknown) and len(mine.older) <= max(remembered, block + unknown)


def test_white_space_that_allows_no_cut(library):
    """Other vocabularies: with a token of a line feed and a space the cut in front of that space isn't certain."""
    spec = json.loads(library.to_str())
    vocab = spec["model"]["vocab"]
    spec["model"]["vocab"] = {t: i for t, i in vocab.items() if i < 256} | {"ĊĠ": 256, "ĠĊĠ": 257, "ab": 258, "aba": 259}
    spec["model"]["merges"], spec["added_tokens"] = ["Ċ Ġ", "Ġ ĊĠ", "a b", "ab a"], []
    library, mine = Tokenizer.from_str(json.dumps(spec)), bpe.ByteBpe(json.dumps(spec))
    assert "\n" in mine.unsure
    rng = random.Random(3)
    texts = ["".join(rng.choices([" ", "\n", "a", "b", "c", "é", "\n ", "  "], k=rng.randint(0, 20))) for _ in range(1000)]
    equal(texts, list(mine.encode_all(texts)), library)


def test_no_merges_at_all(library):
    spec = json.loads(library.to_str())
    spec["model"]["vocab"], spec["model"]["merges"], spec["added_tokens"] = {t: i for t, i in spec["model"]["vocab"].items() if i < 256}, [], []
    texts = ["", "a b", "日本 ab\n"]
    equal(texts, list(bpe.ByteBpe(json.dumps(spec)).encode_all(texts)), Tokenizer.from_str(json.dumps(spec)))
