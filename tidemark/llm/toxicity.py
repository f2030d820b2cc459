"""Toxicity: a linear classifier over character n-grams that are scaled by naive Bayes log-count ratios.

A text is lower-cased and framed by spaces; its distinct n-grams of 3 to 6 code points fall into 2**20 slots. Spark counts, over
all labelled training documents, in how many toxic and how many other ones a slot occurs. The log of the ratio of both
shares is the slot's scale. The slots whose ratio stands out most from its own error are the features: each is its
scale where the text has it, else 0. A logistic model over them is fitted with a pull to 0, on at most `SAMPLE` labelled
documents chosen by a hash of doc_id (the ratios have no such bound). Scoring is one pass: each task looks up the n-grams
of the texts that it reads. What travels is the features' weights, at most `FEATURES` of them.

Defined results: a null or empty text has one n-gram of spaces only and scores near the share of toxic documents. Null labels and
null ids are not learned from; a document with several labels is toxic if one says so; every row of a repeated doc_id counts
for the ratios, one for the fit. Without documents of both kinds every score is the share of toxic ones, counted as if ten
more were clean. Null ids are not held out. An empty table has no rows. Only doc_id and text of the documents are read, so
other columns cannot clash. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.counts import COUNTED, block_batch, filled, summed_tables
from tidemark.llm.tables import table
from tidemark.llm.textbytes import BASE, mix, pieces

SIZES = (3, 4, 5, 6)
SLOT_BITS = 20
FEATURES = 4096
LEAST_SEEN = 3  # labelled documents that a feature needs
LEAST_Z = 2.5  # standard errors by which a feature's log ratio must differ from 0
SAMPLE = 10_000  # labelled documents that the weights are fitted on, at most
PULL = 1.0
THRESHOLD = 0.3
HELD_OUT = 2


def ngram_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of every n-gram of every text, with repeats."""
    framed = [f" {t.lower()} " if t else "  " for t in texts.to_pylist()]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes[(codes >= 9) & (codes <= 13)] = 32
    owner = np.repeat(np.arange(len(framed)), [len(t) for t in framed])
    owners, slots = [], []
    total = np.zeros(len(codes), np.uint64)
    for i in range(max(SIZES)):
        total = total[: len(codes) - i] * BASE + codes[i:]
        if i + 1 in SIZES:
            inside = owner[: len(total)] == owner[i:]
            owners.append(owner[: len(total)][inside])
            slots.append((mix(total[inside]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(slots)


def distinct(owner: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((owner << SLOT_BITS) | slot)
    return keys >> SLOT_BITS, keys & ((1 << SLOT_BITS) - 1)


def once_each(owner: np.ndarray, slot: np.ndarray, texts: int, place: np.ndarray) -> Iterator[np.ndarray]:
    """Per text its different slots, in no order. Of equal slots the last one written to `place` stays; nothing is sorted by slot."""
    order = np.argsort(owner, kind="stable")  # a few sorted runs
    slot, first = slot[order], np.searchsorted(owner[order], np.arange(texts + 1))
    for a, b in zip(first[:-1], first[1:], strict=True):
        own, at = slot[a:b], np.arange(b - a, dtype=place.dtype)
        place[own] = at
        yield own[place[own] == at]


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by slot, for toxic and other ones, and how many there are of either."""
    counts = {name: np.zeros(1 << SLOT_BITS, np.int64) for name in ("toxic", "other")}
    documents, place = np.zeros(2, np.int64), np.empty(1 << SLOT_BITS, np.int32)
    for batch in batches:
        for part in pieces(batch, "text"):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False) > 0
            owner, slot = ngram_slots(part.column("text"))
            for said, slots in zip(toxic, once_each(owner, slot, part.num_rows, place), strict=True):
                counts["toxic" if said else "other"][slots] += 1
            documents += [int(toxic.sum()), int((~toxic).sum())]
    yield block_batch({**counts, "documents": documents})


def log_ratios(toxic: np.ndarray, other: np.ndarray, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per slot the log of the ratio of its shares in both kinds, each count one larger, and that in standard errors."""
    p, q = toxic + 1.0, other + 1.0
    ratio = np.log(p / (documents[0] + 2)) - np.log(q / (documents[1] + 2))
    return ratio, ratio / np.sqrt(1 / p + 1 / q)


def sparse_rows(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in lists]
    return np.repeat(np.arange(len(lists)), sizes), np.array([f for x in lists for f in x], np.int64)


def fit_weights(row: np.ndarray, feature: np.ndarray, scale: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic model on scaled features with a pull to 0: Newton steps by conjugate gradients."""
    n, m = len(labels), len(scale)
    value = scale[feature]

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=value * w[feature], minlength=n) + w[m]

    def back(u: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(feature, weights=value * u[row], minlength=m), u.sum())

    def loss(w: np.ndarray) -> float:
        margin = forward(w)
        return float((np.logaddexp(0, margin) - labels * margin).sum() + (pull * w * w).sum() / 2)

    pull = np.append(np.full(m, PULL), 1e-6)
    share = (labels.sum() + 0.5) / (n + 1)
    w = np.append(np.zeros(m), np.log(share / (1 - share)))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(forward(w), -30, 30)))
        curve = p * (1 - p) + 1e-9
        slope = back(p - labels) + pull * w
        step, rest = np.zeros(m + 1), -slope
        way, square = rest.copy(), float(rest @ rest)
        first = square
        for _ in range(50):
            if square <= 1e-8 * first or square == 0:
                break
            bent = back(curve * forward(way)) + pull * way
            length = square / float(way @ bent)
            step, rest = step + length * way, rest - length * bent
            square, before = float(rest @ rest), square
            way = rest + square / before * way
        size, now = 1.0, loss(w)
        while loss(w + size * step) > now and size > 1e-4:
            size /= 2
        w = w + size * step
        if float(np.abs(size * step).max()) < 1e-5:
            break
    return w[:m], float(w[m])


def hit_batches(slots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id and the numbers of the features that its text has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(1 << SLOT_BITS, -1, np.int64)
        number[slots] = np.arange(len(slots))
        for batch in batches:
            for part in pieces(batch, "text"):
                owner, slot = ngram_slots(part.column("text"))
                known = number[slot] >= 0
                owner, slot = distinct(owner[known], slot[known])
                first = np.searchsorted(owner, np.arange(part.num_rows + 1))
                hits = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(number[slot], pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), hits], ["doc_id", "hits"])

    return rows


def learn_toxicity(docs: DataFrame, labels: DataFrame, train: Column) -> dict:
    """Slots and weights of the features, and the bias. `train` is a condition on doc_id: labels of other rows are not read."""
    told = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(train)
    told = told.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(train)
    # The labels meet the texts in a shuffle at every size; nothing that grows with them is broadcast.
    counted = texts.join(told.hint("merge"), "doc_id").select("text", "toxic").mapInArrow(count_batches, COUNTED)
    tables = summed_tables(counted)
    documents = filled(tables.get("documents", {}), 2)
    plain = {
        "slots": np.zeros(0, np.int64),
        "weights": np.zeros(0),
        "bias": float(np.log((documents[0] + 1) / (documents[1] + 10))),
    }
    if not documents.all():
        return plain
    toxic, other = (filled(tables.get(name, {}), 1 << SLOT_BITS) for name in ("toxic", "other"))
    ratio, z = log_ratios(toxic, other, documents)
    z = np.where(toxic + other >= LEAST_SEEN, np.abs(z), 0)
    slots = np.argsort(-z, kind="stable")[:FEATURES]
    slots = np.sort(slots[z[slots] >= LEAST_Z])
    chosen = told.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    some = texts.join(F.broadcast(chosen.select("doc_id")), "doc_id")  # at most SAMPLE ids
    hits = some.mapInArrow(hit_batches(slots), "doc_id bigint, hits array<int>").groupBy("doc_id").agg(F.min("hits").alias("hits"))
    rows = hits.join(chosen, "doc_id").orderBy("doc_id").collect()  # one row per sampled id
    row, feature = sparse_rows([r.hits for r in rows])
    weights, bias = fit_weights(row, feature, ratio[slots], np.array([r.toxic > 0 for r in rows], float))
    return {"slots": slots, "weights": weights * ratio[slots], "bias": bias}


def margin_batches(model: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(1 << SLOT_BITS)
        weight[model["slots"]] = model["weights"]
        for batch in batches:
            for part in pieces(batch, "text"):
                owner, slot = ngram_slots(part.column("text"))
                known = weight[slot] != 0
                owner, slot = distinct(owner[known], slot[known])
                margin = np.bincount(owner, weights=weight[slot], minlength=part.num_rows) + model["bias"]
                score = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return rows


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score of every row."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        margin_batches(model), "doc_id bigint, score double"
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT
    scores = score_toxicity(docs, learn_toxicity(docs, labels, ~held_out))
    return scores.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
