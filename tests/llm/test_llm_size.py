"""Operators stay within their limits on larger inputs: what would grow too fast or cost too much is not done."""

import numpy as np
import pyarrow as pa

from tidemark.llm import ngram_join, recurrent_lm, toxicity
from tidemark.llm.counts import filled


def test_ngrams_are_counted_without_sorting_them(monkeypatch):
    texts = ["Some words and some words", None, "", "words", "some\tother words", "aaaaaaaaaaaaaaaaaaaa"] * 3
    toxic = [i % 3 == 0 for i in range(len(texts))]
    want = {name: np.zeros(1 << toxicity.SLOT_BITS, np.int64) for name in ("toxic", "other")}
    owner, slot = toxicity.distinct(*toxicity.ngram_slots(pa.array(texts)))
    for i, said in enumerate(toxic):
        want["toxic" if said else "other"][slot[owner == i]] += 1

    def refused(owner, slot):
        raise AssertionError("all n-grams were sorted")

    monkeypatch.setattr(toxicity, "distinct", refused)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([int(x) for x in toxic])], ["text", "toxic"])
    blocks = {}
    for rows in toxicity.count_batches(iter([batch.slice(0, 7), batch.slice(7)])):
        for row in rows.to_pylist():
            blocks.setdefault(row["name"], {})[row["block"]] = np.frombuffer(row["counts"], "<i8")
    for name, counts in want.items():
        assert np.array_equal(filled(blocks[name], 1 << toxicity.SLOT_BITS), counts)
    assert filled(blocks["documents"], 2).tolist() == [6, 12]


def test_candidates_that_cannot_reach_the_threshold_are_not_compared(spark, monkeypatch):
    random = np.random.default_rng(3)
    texts = [" ".join(random.choice(list("ab"), random.integers(12, 30))) for _ in range(150)]
    texts += [t + " b" for t in texts[:20]] + texts[:5]
    asked, links = [], ngram_join.Verifier.links

    def recorded(self, pairs):
        asked.append(pairs.count())
        return links(self, pairs)

    monkeypatch.setattr(ngram_join.Verifier, "links", recorded)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(docs).collect()}
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]
    lowest = list(range(len(texts)))
    for _ in texts:
        before = lowest[:]
        for i, s in enumerate(sets):
            for j, other in enumerate(sets):
                if 100 * len(s & other) >= 80 * len(s | other):
                    lowest[i] = min(lowest[i], lowest[j])
        if lowest == before:
            break
    assert got == dict(enumerate(lowest))
    assert asked[0] < 200  # 237 pairs share an n-gram with the first class that has it, and have like sizes


def test_broadcasts_of_the_join_go_with_their_step(spark, monkeypatch):
    made, gone = [], []
    context, kind = type(spark.sparkContext), type(spark.sparkContext.broadcast(0))
    broadcast, destroy = context.broadcast, kind.destroy

    def recorded(self, value):
        shared = broadcast(self, value)
        if not isinstance(value, bytes):  # Spark sends large functions as bytes
            made.append(shared)
        return shared

    monkeypatch.setattr(context, "broadcast", recorded)
    monkeypatch.setattr(kind, "destroy", lambda self, *how: gone.append(self) or destroy(self, *how))
    docs = spark.range(60).selectExpr("id AS doc_id", "concat('one two three four five six seven eight nine ', id % 20) AS text")
    assert ngram_join.similar_groups(docs).count() == 60
    assert len(made) >= 3 and {id(b) for b in made} == {id(b) for b in gone}


def test_a_window_of_training_has_many_lanes(monkeypatch):
    vocabulary = recurrent_lm.Vocabulary(
        None, np.array([5, 3, 1, 0]), 2, 11, 4, np.zeros(16, np.int64), np.zeros(16, np.int64), None, np.append(np.arange(18), 20), np.append(np.arange(17), [17] * 3)
    )
    trained, window = [], recurrent_lm.train_window

    def recorded(w, v, ids, begins, state):
        trained.append(ids.size)
        return window(w, v, ids, begins, state)

    monkeypatch.setattr(recurrent_lm, "train_window", recorded)
    ids = np.random.default_rng(1).integers(0, 20, 16 * 128 * 4)
    weights = recurrent_lm.initial_weights(vocabulary)
    squares = {name: np.full(value.shape, 0.1, np.float32) for name, value in weights.items()}
    recurrent_lm.train_stream(weights, vocabulary, ids, np.zeros(len(ids), bool), squares)
    assert sum(trained) == len(ids) and len(trained) <= 4
    assert all(np.isfinite(w).all() for w in weights.values())
