"""What Python workers hold at once, and what they give back."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from gleaner.llm import common, packing, pii, toxicity
from gleaner.llm.common import WORD_BPE
from gleaner.llm.packing import WordTokenizer
from gleaner.runtime import ARROW_BYTES

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def plain_session(spark):
    spark.conf.unset(SETTING)
    yield spark
    spark.conf.unset(SETTING)


def largest_batch(frame):
    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [int(batch["text"].str.len().sum())]})

    return max(r["n"] for r in frame.coalesce(1).mapInPandas(sizes, "n bigint").collect())


@pytest.mark.parametrize("stage", ["simhash", "pii", "packing"])
def test_stages_send_texts_in_small_batches(plain_session, stage):
    docs = plain_session.range(600).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 5000) as text")
    docs = docs.selectExpr("*", "cast(length(text) as bigint) as n_chars")
    dict(corpus_pipeline.STAGES)[stage](plain_session, docs, "")
    assert largest_batch(docs) < 2 * ARROW_BYTES


def test_a_session_keeps_its_own_batches(plain_session):
    plain_session.conf.set(SETTING, "1m")
    corpus_pipeline.redact_pii(plain_session, plain_session.range(1).selectExpr("'a' as text", "1L as n_chars"), "")
    assert plain_session.conf.get(SETTING) == "1m"


class Pool:
    released = 0

    def release_unused(self):
        self.released += 1


def test_memory_is_released_when_a_task_ends(monkeypatch):
    pool = Pool()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    work = common.released(lambda batches: (x + 1 for x in batches))
    assert list(work(iter([1, 2]))) == [2, 3] and pool.released == 1
    rows = work(iter([1, 2]))
    next(rows)
    rows.close()  # a task that is not read to its end
    assert pool.released == 2


@pytest.mark.parametrize("most", [1, 3, 1_000])
def test_new_words_are_learned_in_portions(monkeypatch, most):
    monkeypatch.setattr(packing, "NEW_WORDS", most)
    tokenizer = WordTokenizer(WORD_BPE)
    portions, learn = [], tokenizer.learn
    monkeypatch.setattr(tokenizer, "learn", lambda words: portions.append(len(words)) or learn(words))
    texts = ["The dark forest, isn't it?  The forest", "", "a1b2 naïve £5 quixotic zephyrs", "日本 the forest"]
    for _ in range(2):
        got = [ids.tolist() for ids in tokenizer.batch(texts)]
        assert got == [tokenizer.model.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < max(portions) <= most
    assert list(tokenizer.batch([""]))[0].tolist() == []


def test_small_batches_count_words_as_one(plain_session, monkeypatch):
    rows = [(i, "alpha beta" if i % 2 else "alpha gamma", i % 2 == 0) for i in range(50)]
    frame = plain_session.createDataFrame(rows, "id bigint, text string, toxic boolean").coalesce(1)
    model = toxicity.CharacterModel.of(np.zeros(0, np.int64), np.zeros(0))
    counted = lambda: sorted(map(tuple, toxicity.word_counts(frame, model).collect()))
    expected = counted()
    plain_session.conf.set(SETTING, "64")
    assert counted() == expected and ("alpha", 25, 25) in expected


def test_redaction_keeps_nulls_in_small_batches(plain_session):
    plain_session.conf.set(SETTING, "64")
    rows = [(i, None if i % 3 == 0 else "" if i % 3 == 1 else f"write to a{i}@b.example now") for i in range(40)]
    found = pii.redact(plain_session.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {tuple(r) for r in found} == {(i, t and "write to [EMAIL] now") for i, t in rows}
