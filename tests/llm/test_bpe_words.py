"""Words of many texts are encoded together."""

import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers, trainers

from loquent.llm import bpe


def counted(own: bpe.Tokenizer) -> list[bytes]:
    """The words that the automaton is asked for from now on."""
    asked, encode = [], own.automaton.encode

    def ask(word: bytes) -> list[int]:
        asked.append(word)
        return encode(word)

    own.automaton.encode = ask
    return asked


def rare(n: int, seed: int) -> list[str]:
    """Distinct words, none a token."""
    rng = random.Random(seed)
    return list({" " + "".join(rng.choices("xqzjkvw", k=11)) for _ in range(n)})


@pytest.fixture
def own():
    return bpe.Tokenizer(bpe.default_path())


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(bpe.default_path())


def test_a_word_of_a_text_is_encoded_once(own, theirs):
    """Finding: beyond KEPT_WORDS distinct words all were dropped and encoded anew."""
    words = rare(bpe.KEPT_WORDS + 2000, 1)
    text = "".join(words + words)
    asked = counted(own)
    assert own.encode(text) == theirs.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked))
    assert len(own.words.kept) <= bpe.KEPT_WORDS


def test_words_met_once_push_out_no_frequent_ones(own):
    frequent = ["a", *rare(500, 2)]
    own.encode("".join(frequent * 3))
    own.encode("".join(rare(2 * bpe.KEPT_WORDS, 3)))
    own.encode("".join(frequent * 3))
    own.encode("".join(rare(bpe.KEPT_WORDS, 4)))
    assert len(own.words.kept) <= bpe.KEPT_WORDS
    asked = counted(own)
    own.encode("".join(frequent))
    assert not asked


def test_groups_of_texts_keep_their_order(own, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "TOGETHER", 40)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 8)
    rng = random.Random(5)
    pieces = ["a", " the", "  ", "\n", "ä", "漢", "🙂", "'s", " 22", "<|endoftext|>", "q" * 60]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(300)]
    got = [np.frombuffer(x, "<u4").tolist() for x in own.packed(texts)]
    assert got == [theirs.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.words.kept) <= 8
    assert list(own.packed([])) == []


@pytest.mark.parametrize("letters", ["ab ", "abcé "])
def test_trained_vocabularies_equal_the_library(letters, tmp_path):
    rng = random.Random(6)

    def text(n: int) -> str:
        return "".join(rng.choice(letters) * rng.choice((1, 1, 2, 3)) for _ in range(n))

    theirs = Tokenizer(models.BPE())
    theirs.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = trainers.BpeTrainer(
        vocab_size=400, initial_alphabet=sorted(bpe.byte_letters()), show_progress=False
    )
    theirs.train_from_iterator([text(200) for _ in range(20)], trainer)
    theirs.save(str(tmp_path / "small.json"))
    merges = json.loads((tmp_path / "small.json").read_text())["model"]["merges"]
    own = bpe.Tokenizer(str(tmp_path / "small.json"))
    assert len(merges) > 50
    for _ in range(300):
        some = text(rng.randint(1, 40))
        assert own.encode(some) == theirs.encode(some, add_special_tokens=False).ids
