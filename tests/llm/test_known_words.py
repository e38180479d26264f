"""Words that a worker met before are not encoded again."""

import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from gleaner.llm import packing
from gleaner.llm.common import WORD_BPE
from gleaner.llm.packing import WordTokenizer

BATCHES = [
    ["The dark forest, isn't it?  The forest", "", "a1b2 naïve £5"],
    ["forest of the dark", "Zwölf Boxkämpfer", "日本 the forest", "it <|endoftext|> isn't"],
    ["naïve the naïve", "new words: quixotic, zephyr"],
    ["quixotic zephyr's dark"],
]


@pytest.mark.parametrize("most, chars", [(1_000_000, 16 << 20), (3, 16 << 20), (0, 16 << 20), (1_000_000, 20)])
def test_remembered_words_give_the_ids_of_the_library(monkeypatch, most, chars):
    monkeypatch.setattr(packing, "KNOWN_WORDS", most)
    monkeypatch.setattr(packing, "KNOWN_BYTES", chars)
    tokenizer = WordTokenizer(WORD_BPE)
    for texts in BATCHES * 2:
        got = [ids.tolist() for ids in tokenizer.batch(texts)]
        assert got == [tokenizer.model.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(tokenizer.words) <= most and len(tokenizer.starts) == len(tokenizer.words) + 1
        assert sum(map(len, tokenizer.words.to_pylist())) <= chars


def test_a_known_word_is_not_learned_again(monkeypatch):
    tokenizer = WordTokenizer(WORD_BPE)
    learned, learn = [], tokenizer.learn
    monkeypatch.setattr(tokenizer, "learn", lambda words: learned.extend(words) or learn(words))
    for texts in BATCHES * 2:
        assert all(isinstance(ids, np.ndarray) for ids in tokenizer.batch(texts))
    assert len(learned) == len(set(learned)) > 10


def test_the_next_task_has_the_tokenizer_of_the_last(monkeypatch):
    kept = packing.tokenizer_of(WORD_BPE)
    assert packing.tokenizer_of(WORD_BPE) is kept
    # Workers without the repository have what the job brought along, and no module to keep it in.
    sent = cloudpickle.loads(cloudpickle.dumps(packing.tokenizer_of))
    monkeypatch.setitem(sys.modules, "gleaner.llm", None)
    alone = sent(WORD_BPE)
    assert alone is not kept and [i.tolist() for i in alone.batch(["the forest"])] == [i.tolist() for i in kept.batch(["the forest"])]
