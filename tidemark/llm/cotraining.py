"""Quality classifier by co-training: a text view and a page view teach each other, and calibrated views score everything.

Text view: which words, and which beginnings of words, a text has (hashed, each once). Page view: what can be told without
reading: source, language, length, lines, shares of capitals, digits, punctuation and repetition, each in steps. Both
are sparse logistic models in numpy.

Fitting takes a bounded sample, at most `SAMPLE` labelled and `SAMPLE` unlabelled documents, chosen by a hash of doc_id.
In each of `ROUNDS` rounds both views are fitted; each then gives its most confident labels on the unlabelled documents,
in the proportion of the classes, to the other one. At the end each view is calibrated (a logistic curve over its margin)
on labelled documents that neither has learned from, and the calibrated views are combined in the same way.
One pass then scores all documents, each in the task that reads it.

Defined results: a null or empty text has no words and the page features of length 0. A null source or language is a value
of its own. Labels without a value are not learned from; where one doc_id has several, the smallest counts; of
rows with one doc_id that of the smallest text hash is fitted on. With no labels,
or labels of one class only, every document gets that class's share (one half if there are none). Repeated rows and null
ids are scored like others. An empty table gives no rows. Of the documents doc_id, text, lang and source are read, so other
columns cannot clash. Texts are read as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import table
from tidemark.llm.textbytes import mix, pieces, span_hashes, split_words, text_buffers, word_hashes

SAMPLE = 12_000  # bound of the labelled, and of the unlabelled, documents that are fitted on
ROUNDS = 3
GIVEN = 0.1  # share of the unlabelled sample that a view labels for the other one per round
CALIBRATION = 4  # every fourth labelled document is kept for calibration
WORD_BITS = 18
PAGE_SLOTS = 1 << 12
STEPS = 16
PREFIX = 4  # bytes
EPOCHS = 8
LEARNING = 0.5
LEAST_SEEN = 3  # documents of the sample that a feature needs
TARGETS = ("quality", "toxic")


def distinct_slots(owner: np.ndarray, slot: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each (owner, slot) once, by owner."""
    keys = np.unique((owner.astype(np.int64) << bits) | slot)
    return keys >> bits, keys & ((1 << bits) - 1)


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of the words and word beginnings of each text."""
    words = split_words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.first))
    starts = span_hashes(words.data, words.start, np.minimum(words.start + PREFIX, words.end))
    shift = np.uint64(64 - WORD_BITS)
    whole = (word_hashes(words) >> shift).astype(np.int64)
    begun = (mix(starts + np.uint64(1)) >> shift).astype(np.int64)
    return distinct_slots(np.append(owner, owner), np.append(whole, begun), WORD_BITS)


def page_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of the page view: one slot per feature and step."""
    texts, n = batch.column("text"), batch.num_rows
    data, at = text_buffers(texts)
    size = np.diff(at)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return (total[at[1:]] - total[at[:-1]]) / np.maximum(size, 1)

    words = split_words(texts)
    owner = np.repeat(np.arange(n), np.diff(words.first))
    hashes = word_hashes(words)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    count = np.bincount(owner, minlength=n)
    different = np.bincount(distinct_slots(owner, (hashes >> np.uint64(40)).astype(np.int64), 24)[0], minlength=n)
    closes = np.zeros(len(hashes))
    if len(hashes):
        last = data[words.end - 1]
        closes = ((last < 48) | (last > 57) & (last < 65) | (last > 90) & (last < 97) | (last > 122) & (last < 128)).astype(float)
    lines = share(data == 10) * size + 1
    upper = (data >= 65) & (data <= 90)
    punct = (data > 32) & (data < 48) | (data > 57) & (data < 65) | (data > 90) & (data < 97) | (data > 122) & (data < 127)
    digit = (data >= 48) & (data <= 57)
    values = [
        np.log2(size + 1) / 20,
        np.log2(lines) / 12,
        np.log2(size / lines + 1) / 16,
        np.sqrt(share(upper)),
        np.sqrt(share(punct)),
        np.sqrt(share(digit)),
        np.sqrt(share(data >= 128)),
        np.sqrt(np.bincount(owner, weights=again, minlength=n) / np.maximum(count, 1)),
        different / np.maximum(count, 1),
        np.bincount(owner, weights=closes, minlength=n) / np.maximum(count, 1),
    ]
    slots = [np.clip(np.floor(v * STEPS), 0, STEPS - 1).astype(np.int64) + i * STEPS for i, v in enumerate(values)]
    first = len(values) * STEPS
    for column in ("source", "lang"):
        names = batch.column(column).fill_null("\0")
        _, bounds = text_buffers(names)
        raw, _ = text_buffers(names)
        code = span_hashes(raw, bounds[:-1], bounds[1:]) + np.uint64(column == "lang")
        slots.append(first + (mix(code) % np.uint64(PAGE_SLOTS - first)).astype(np.int64))
    return np.tile(np.arange(n), len(slots)), np.concatenate(slots)


class Rows(NamedTuple):
    """Sparse 0/1 rows: row i has slots slot[first[i]:first[i + 1]]."""

    first: np.ndarray
    slot: np.ndarray

    def pick(self, which: np.ndarray) -> Rows:
        sizes = np.diff(self.first)[which]
        upto = np.cumsum(sizes)
        inside = np.arange(int(upto[-1]) if len(upto) else 0) - np.repeat(upto - sizes, sizes)
        return Rows(np.append(0, upto), self.slot[np.repeat(self.first[:-1][which], sizes) + inside])

    def margins(self, weights: np.ndarray, bias: float) -> np.ndarray:
        total = np.append(0, np.cumsum(weights[self.slot].astype(np.float64)))
        return total[self.first[1:]] - total[self.first[:-1]] + bias


def as_rows(owner: np.ndarray, slot: np.ndarray, n: int) -> Rows:
    order = np.argsort(owner, kind="stable")
    return Rows(np.searchsorted(owner[order], np.arange(n + 1)), slot[order])


FEATURES = "doc_id bigint, words array<int>, page array<int>"


def feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in pieces(batch, "text"):
            lists = []
            for owner, slot in (text_features(part.column("text")), page_features(part)):
                rows = as_rows(owner, slot, part.num_rows)
                lists.append(pa.ListArray.from_arrays(pa.array(rows.first, pa.int32()), pa.array(rows.slot, pa.int32())))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], ["doc_id", "words", "page"])


def fit_logistic(rows: Rows, labels: np.ndarray, slots: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a sparse logistic model; features of fewer than LEAST_SEEN rows stay at 0."""
    random = np.random.default_rng(3)
    seen = np.bincount(rows.slot, minlength=slots) >= LEAST_SEEN
    n = len(labels)
    share = np.clip(labels.mean(), 0.01, 0.99)
    weights, squares = np.zeros(slots), np.full(slots, 1.0)
    bias = float(np.log(share / (1 - share)))
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for at in range(0, n, 64):
            which = order[at : at + 64]
            some = rows.pick(which)
            error = 1 / (1 + np.exp(-np.clip(some.margins(weights, bias), -30, 30))) - labels[which]
            slot, place = np.unique(some.slot, return_inverse=True)
            grad = np.bincount(place, weights=np.repeat(error, np.diff(some.first)), minlength=len(slot)) * seen[slot]
            squares[slot] += grad * grad
            weights[slot] -= LEARNING * grad / np.sqrt(squares[slot])
            weights[slot] = np.sign(weights[slot]) * np.maximum(np.abs(weights[slot]) - 2e-4, 0)
            bias -= 0.01 * float(error.mean())
    return weights.astype(np.float32), bias


def fit_curve(margins: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic model over a few dense columns and 1, with a light pull to 0."""
    x = np.column_stack([margins, np.ones(len(labels))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (p - labels) + 1e-2 * w)
    return w


class Target(NamedTuple):
    """Both views of one label, with their calibration and combination."""

    words: np.ndarray
    words_bias: float
    page: np.ndarray
    page_bias: float
    words_curve: np.ndarray
    page_curve: np.ndarray
    combined: np.ndarray
    share: float | None  # set if there was nothing to tell apart

    def scores(self, words: Rows, page: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities by text, by page and by both."""
        if self.share is not None:
            same = np.full(len(words.first) - 1, self.share)
            return same, same, same
        a = np.clip(words.margins(self.words, self.words_bias), -30, 30) * self.words_curve[0] + self.words_curve[1]
        b = np.clip(page.margins(self.page, self.page_bias), -30, 30) * self.page_curve[0] + self.page_curve[1]
        both = a * self.combined[0] + b * self.combined[1] + self.combined[2]
        return tuple(1 / (1 + np.exp(-np.clip(m, -30, 30))) for m in (a, b, both))


def confident(margins: np.ndarray, free: np.ndarray, share: float, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The most confident rows of either side among the free ones, in the proportion of the classes, and their labels."""
    ups = max(1, round(number * share))
    order = np.flatnonzero(free)[np.argsort(margins[free], kind="stable")]
    low, high = order[: max(1, number - ups)], order[len(order) - ups :]
    low, high = low[margins[low] < -1], high[margins[high] > 1]
    return np.append(low, high), np.append(np.zeros(len(low)), np.ones(len(high)))


def cotrain(words: Rows, page: Rows, labels: np.ndarray, n_labelled: int) -> Target:
    """Rows 0 to n_labelled - 1 are labelled (nan: not for this label), the others are not."""
    known = np.flatnonzero(~np.isnan(labels))
    empty = np.zeros(0)
    share = float(labels[known].mean()) if len(known) else 0.5
    if share in (0.0, 1.0) or len(known) < 2 * CALIBRATION:
        return Target(empty, 0.0, empty, 0.0, empty, empty, empty, share)
    aside = known[::CALIBRATION]
    learned = np.setdiff1d(known, aside)
    total = len(words.first) - 1
    given = [(learned, labels[learned]), (learned, labels[learned])]
    free = [np.arange(total) >= n_labelled, np.arange(total) >= n_labelled]
    views = (words, page)
    slots = (1 << WORD_BITS, PAGE_SLOTS)
    fitted = [fit_logistic(views[i].pick(given[i][0]), given[i][1], slots[i]) for i in (0, 1)]
    for _ in range(ROUNDS):
        for teacher in (0, 1):
            pupil = 1 - teacher
            if not free[pupil].any():
                continue
            margins = views[teacher].margins(*fitted[teacher])
            rows, told = confident(margins, free[pupil], share, int(GIVEN * (total - n_labelled)))
            free[pupil][rows] = False
            given[pupil] = (np.append(given[pupil][0], rows), np.append(given[pupil][1], told))
        fitted = [fit_logistic(views[i].pick(given[i][0]), given[i][1], slots[i]) for i in (0, 1)]
    margins = [np.clip(views[i].pick(aside).margins(*fitted[i]), -30, 30) for i in (0, 1)]
    curves = [fit_curve(m[:, None], labels[aside]) for m in margins]
    calibrated = np.column_stack([m * c[0] + c[1] for m, c in zip(margins, curves, strict=True)])
    return Target(*fitted[0], *fitted[1], *curves, fit_curve(calibrated, labels[aside]), None)


def chosen_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source", "lang")


def sample_features(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Features of the documents with the ids of `sample`, of rows with one id those of the smallest text hash: one row per id."""
    row = F.struct(F.xxhash64("text").alias("hash"), "source", "lang", "text")
    one = chosen_columns(docs).join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min(row).alias("row"))
    return one.select("doc_id", "row.text", "row.source", "row.lang").mapInArrow(feature_batches, FEATURES)


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, Target]:
    """Co-trained models of all labels, from bounded samples."""
    told = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    told = told.agg(*[F.min(t).cast("double").alias(t) for t in TARGETS])
    by_hash = F.xxhash64("doc_id")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    labelled = told.join(ids, "doc_id", "left_semi").orderBy(by_hash, "doc_id").limit(SAMPLE).toPandas()
    others = ids.join(told, "doc_id", "left_anti").orderBy(by_hash, "doc_id").limit(SAMPLE)
    sample = others.select("doc_id")
    if len(labelled):
        sample = docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(labelled["doc_id"], pa.int64())})).union(sample)
    # At most 2 * SAMPLE ids.
    rows = sample_features(docs, sample).toArrow()
    order = {doc: i for i, doc in enumerate(labelled["doc_id"])}
    at = sorted((order.get(doc, len(order)), doc, i) for i, doc in enumerate(rows.column("doc_id").to_pylist()))
    which = np.array([i for _, _, i in at], np.int64)
    n_labelled = sum(o < len(order) for o, _, _ in at)

    def view(name: str) -> Rows:
        column = rows.column(name).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int32()))
        first = column.offsets.to_numpy().astype(np.int64)
        return Rows(first, column.values.to_numpy()).pick(which)

    words, page = view("words"), view("page")
    targets = {}
    for name in TARGETS:
        values = np.full(len(which), np.nan)
        values[:n_labelled] = labelled[name].to_numpy(float)[[o for o, _, _ in at[:n_labelled]]]
        targets[name] = cotrain(words, page, values, n_labelled)
    return targets


SCORED = "doc_id bigint, score double, text_score double, page_score double, toxic_score double, keep boolean"


def score_batches(shared: Broadcast):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets: dict[str, Target] = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                n = part.num_rows
                words = as_rows(*text_features(part.column("text")), n)
                page = as_rows(*page_features(part), n)
                text_score, page_score, score = targets["quality"].scores(words, page)
                toxic = targets["toxic"].scores(words, page)[2]
                keep = (score >= 0.5) & (toxic < 0.5)
                arrays = [pa.array(a) for a in (score, text_score, page_score, toxic, keep)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *arrays], ["doc_id", "score", "text_score", "page_score", "toxic_score", "keep"]
                )

    return rows


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, score (of good quality), the views' scores, toxic_score, keep."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return chosen_columns(docs).mapInArrow(score_batches(shared), SCORED)


def op6_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
