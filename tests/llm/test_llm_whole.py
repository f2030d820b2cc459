"""Operators do their whole job: nothing is left out by a sample, a cap or a shape of the input."""

import numpy as np

from tidemark.llm import recurrent_lm
from tidemark.llm.cotraining import fit
from tidemark.llm.decontaminate import contaminated


def test_every_training_word_is_learned_from(spark, monkeypatch):
    seen = []
    summed = recurrent_lm.summed_tables

    def recorded(counted):
        sums = summed(counted)
        seen.append(int(recurrent_lm.filled(sums.get("seen", {}), 1)[0]))
        return sums

    monkeypatch.setattr(recurrent_lm, "summed_tables", recorded)
    docs = spark.range(200).selectExpr("id AS doc_id", "concat('some words of text ', id % 9, ' and more') AS text").repartition(3)
    model, _ = recurrent_lm.fit(spark, docs)
    assert model.v.total == 200 * 8 and sum(seen) == model.v.total


def test_no_word_is_lost_between_lanes(monkeypatch):
    vocabulary = recurrent_lm.Vocabulary(
        None, np.array([5, 3, 1, 0]), 2, 11, 4, np.zeros(16, np.int64), np.zeros(16, np.int64), None, np.append(np.arange(18), 20), np.append(np.arange(17), [17] * 3)
    )
    trained, window = [], recurrent_lm.train_window

    def recorded(w, v, ids, begins, state):
        trained.extend(ids.ravel().tolist())
        return window(w, v, ids, begins, state)

    monkeypatch.setattr(recurrent_lm, "train_window", recorded)
    ids = np.random.default_rng(1).integers(0, 20, 16 * 32 * 2 + 31)
    weights = recurrent_lm.initial_weights(vocabulary)
    squares = {name: np.full(value.shape, 0.1, np.float32) for name, value in weights.items()}
    recurrent_lm.train_stream(weights, vocabulary, ids, np.zeros(len(ids), bool), squares)
    assert sorted(trained) == sorted(ids.tolist())


def test_short_slot_rich_and_opening_names(spark):
    items = [
        (1, "What is 12 plus 30?"),
        (2, "Tom has 3 apples and gives 2 of them to his sister. How many are left?"),
        (3, "On 3 May 2019 Anna Maria Lopez paid 15 euros and 20 cents to Peter Paul Meier in Rome for 2 books."),
        (4, "Anna has 3."),
    ]
    docs = [
        (1, "Exercises. What is 45 plus 7? Write it down."),
        (2, "Bob has 5 apples and gives 4 of them to his sister. How many are left?"),
        (3, "Text. On 7 June 2021 Berta Clara Gomez paid 99 euros and 10 cents to Karl Otto Huber in Oslo for 8 books. More."),
        (4, "Do what is 45 minus 7? They say that Bob has 5 of them and then"),
        (5, "Bob has 5 apples and sells 4 of them to her sister. How many are there?"),
        (6, "It is so. Bob has 5. It is so."),
    ]
    frames = (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    rows = contaminated(*frames).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (2, 2), (3, 3), (6, 4)}
    assert all(0.5 <= r.coverage <= 1 for r in rows)


def test_repeated_ids_reach_the_driver_once(spark, monkeypatch):
    arrived, arrow = [], type(spark.range(1)).toArrow

    def recorded(frame):
        table = arrow(frame)
        arrived.append(table.num_rows)
        return table

    monkeypatch.setattr(type(spark.range(1)), "toArrow", recorded)
    docs = spark.range(600).selectExpr("IF(id % 3 = 0, 1, id) AS doc_id", "concat('text ', id) AS text", "'a' AS source", "'en' AS lang")
    labels = spark.range(1, 40).selectExpr("id AS doc_id", "int(id % 2) AS quality", "int(id % 3 = 0) AS toxic")
    fit(docs, labels)
    assert arrived == [docs.select("doc_id").distinct().count()]
