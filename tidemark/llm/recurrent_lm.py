"""Language model scoring with a gated recurrent network in numpy.

Counts. One pass counts every word of the training documents; the counts are a written table. The `KNOWN` most frequent
words travel to the tasks (a table of fixed size), the others meet their counts in a join.

Model. The `MODEL_WORDS` most frequent words have embeddings; a GRU reads them one by one. The output softmax is
class-factored: words are put into classes of like total frequency, first the class is predicted, then the word among
its class. The end of a text is a class, and the words without an embedding are a few more (by their last two bytes).
Such a word then costs, inside its class, its training count with absolute discounting, and the discounted mass goes by
spelling: bytes given the three before them, smoothed with shorter contexts.

Training is truncated back-propagation through time over windows of `WINDOW` words; the state is carried from window to
window and begins anew with each document. It runs where the data is: in each of `ROUNDS` rounds every task trains, from
the same weights, on its training documents of that round (whole documents, one in `ROUNDS`, others each round), and Spark
averages the weights by words seen. So over all rounds every word of every training document is learned from once, and no
task or driver holds more than one model.

Scoring runs all documents of a batch side by side in windows, with the state carried over, so every word of a document
is scored with all words before it as context.

Defined results: a null or empty text is the end token only. A null doc_id is not held out. Repeated rows are counted and
scored each for itself. Without training documents every count is 0, and scores come from spelling alone. Very long texts
are scored as a whole; one text is the unit of memory. An empty table gives no rows. Of the input only doc_id and text
are read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.counts import COUNTED, block_batch, filled, summed_tables
from tidemark.llm.tables import table
from tidemark.llm.textbytes import Words, mix, pieces, split_words, word_hashes
from tidemark.session import materialize

KNOWN = 1 << 16
MODEL_WORDS = 4096
HIDDEN = 32
CLASSES = 48  # of words with embeddings
OTHER = 16  # classes of words without
WINDOW = 16
TRAIN_LANES = 128
GRADIENT_LANES = 32  # of whose gradients the mean is taken at most; of more lanes the sum is larger
ROUNDS = 2
RATE = 0.3
DISCOUNT = 0.75
LETTERS = 40  # symbols of the spelling model: the word's edge, the most frequent bytes, and all others
HELD_WORDS = 1_500_000  # words that a task scores side by side
FIXED_POINT = float(1 << 20)
END = 0  # ids: the end of a text, then the other-word classes, then words
FIRST_WORD = 1 + OTHER


class HashIndex:
    """Places of some distinct 64-bit hashes: two direct tables by different bits, and a sorted rest."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys.astype(np.uint64), np.uint64(0))
        self.tables = []
        rest = np.arange(len(keys), dtype=np.int32)
        for shift in (44, 24):
            place = np.full(1 << 20, len(keys), np.int32)
            slot = self.slot(keys[rest], shift)
            place[slot] = rest
            self.tables.append((shift, place))
            rest = rest[place[slot] != rest]
        order = rest[np.argsort(keys[rest])]
        self.sorted_keys, self.sorted_places = keys[order], order

    @staticmethod
    def slot(hashes: np.ndarray, shift: int) -> np.ndarray:
        return ((hashes >> np.uint64(shift)) & np.uint64((1 << 20) - 1)).astype(np.int64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or the number of keys if it is none of them."""
        none = len(self.keys) - 1
        found = np.full(len(hashes), none, np.int32)
        for shift, place in self.tables:
            guess = place[self.slot(hashes, shift)]
            found = np.where((self.keys[guess] == hashes) & (guess < none), guess, found)
        if len(self.sorted_keys):
            at = np.minimum(np.searchsorted(self.sorted_keys, hashes), len(self.sorted_keys) - 1)
            found = np.where(self.sorted_keys[at] == hashes, self.sorted_places[at], found)
        return found


def other_class(words: Words) -> np.ndarray:
    """Class of each word by its last two bytes, from 0."""
    last = words.data[words.end - 1].astype(np.uint64) if len(words.end) else np.zeros(0, np.uint64)
    second = words.data[np.maximum(words.end - 2, words.start)].astype(np.uint64) if len(words.end) else last
    return (mix(last * np.uint64(256) + second) & np.uint64(OTHER - 1)).astype(np.int64)


WORD_COUNTS = "kind int, hash bigint, other int, n bigint"


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0) and bytes (kind 1) of a task's texts, with their numbers."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    letters = np.zeros(256, np.int64)

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, other, n = (np.concatenate(c) for c in zip(*held, strict=True))
        unique, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        return unique, other[first], np.bincount(place, weights=n, minlength=len(unique)).astype(np.int64)

    for batch in batches:
        for part in pieces(batch, "text"):
            words = split_words(part.column("text"))
            hashes, first, n = np.unique(word_hashes(words), return_index=True, return_counts=True)
            picked = Words(words.data, words.start[first], words.end[first], words.first)
            held.append((hashes, other_class(picked), n))
            letters += np.bincount(words.data, minlength=256)
            if len(held) == 32:
                held = [merged()]
    if held:
        hashes, other, n = merged()
        bytes_seen = np.flatnonzero(letters)
        columns = {
            "kind": np.append(np.zeros(len(hashes), np.int32), np.ones(len(bytes_seen), np.int32)),
            "hash": np.append(hashes.view(np.int64), bytes_seen),
            "other": np.append(other.astype(np.int32), np.zeros(len(bytes_seen), np.int32)),
            "n": np.append(n, letters[bytes_seen]),
        }
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


class Vocabulary(NamedTuple):
    """What tasks know of the counts. All of a size that does not grow with the corpus."""

    index: HashIndex  # the KNOWN most frequent words, most frequent first
    counts: np.ndarray  # their counts, and 0 for what is not among them
    ends: int  # training documents
    total: int  # N
    distinct: int  # V
    other_words: np.ndarray  # per other-word class: words counted, of those without an embedding
    other_types: np.ndarray  # different ones
    letter: np.ndarray  # byte to symbol
    first: np.ndarray  # word classes: class k has ids first[k] to first[k + 1]
    class_of: np.ndarray  # id to class


def build_vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    words = counts.filter("kind = 0")
    sums = words.groupBy("other").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).collect()
    frequent = words.orderBy(F.desc("n"), "hash").limit(KNOWN).select("hash", "other", "n").toArrow()
    letters = counts.filter("kind = 1").orderBy(F.desc("n"), "hash").limit(LETTERS - 2).collect()  # at most 256 rows
    hashes = frequent.column("hash").to_numpy().view(np.uint64)
    n = frequent.column("n").to_numpy()
    other = frequent.column("other").to_numpy()
    shown = min(MODEL_WORDS - FIRST_WORD, len(n))
    all_words, all_types = np.zeros(OTHER, np.int64), np.zeros(OTHER, np.int64)
    for row in sums:
        all_words[row.other], all_types[row.other] = row.n, row.types
    letter = np.full(256, LETTERS - 1)
    spaces = {9, 10, 11, 12, 13, 32}
    for i, row in enumerate(r for r in letters if r.hash not in spaces):
        letter[row.hash] = 1 + i
    # Classes of like mass: the end and each other-word class are one each, words follow by falling frequency.
    mass = np.cumsum(n[:shown])
    word_class = (mass - 1) * CLASSES // max(int(mass[-1]) if shown else 1, 1)
    _, word_class = np.unique(word_class, return_inverse=True)
    class_of = np.concatenate([np.arange(FIRST_WORD), FIRST_WORD + word_class])
    first = np.searchsorted(class_of, np.arange(int(class_of[-1]) + 2))
    return Vocabulary(
        HashIndex(hashes),
        np.append(n, 0),
        ends,
        int(all_words.sum()) + ends,
        int(all_types.sum()) + (ends > 0),
        all_words - np.bincount(other[:shown], weights=n[:shown], minlength=OTHER).astype(np.int64),
        all_types - np.bincount(other[:shown], minlength=OTHER),
        letter,
        first,
        class_of,
    )


def initial_weights(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Small random weights, the same everywhere; the output begins as the frequencies."""
    random = np.random.default_rng(7)
    size, classes = len(vocabulary.class_of), len(vocabulary.first) - 1
    words = size - FIRST_WORD
    n = np.concatenate([[vocabulary.ends], vocabulary.other_words, vocabulary.counts[:words]]) + 0.5
    by_class = np.bincount(vocabulary.class_of, weights=n)

    def some(*shape: int) -> np.ndarray:
        return random.normal(0, 0.1, shape).astype(np.float32)

    return {
        "embed": some(size, HIDDEN),
        "input": some(HIDDEN, 3 * HIDDEN),
        "state": some(HIDDEN, 3 * HIDDEN),
        "gate_bias": np.zeros(3 * HIDDEN, np.float32),
        "class": np.zeros((HIDDEN, classes), np.float32),
        "class_bias": np.log(by_class / by_class.sum()).astype(np.float32),
        "word": np.zeros((size, HIDDEN), np.float32),
        "word_bias": np.log(n / by_class[vocabulary.class_of]).astype(np.float32),
    }


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def gru_step(w: dict, projected: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """New state from the projected input (with bias) and the state; also what going back needs."""
    recurrent = state @ w["state"]
    gates = sigmoid(projected[:, : 2 * HIDDEN] + recurrent[:, : 2 * HIDDEN])
    keep, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
    inner = recurrent[:, 2 * HIDDEN :]
    new = np.tanh(projected[:, 2 * HIDDEN :] + reset * inner)
    return new + keep * (state - new), keep, reset, inner, new


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def output_scores(w: dict, v: Vocabulary, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log-probability of each id after each state: of its class, and within the class."""
    classes = v.class_of[ids]
    each = np.arange(len(ids))
    scores = log_softmax(states @ w["class"] + w["class_bias"])[each, classes]
    for k, rows in class_rows(v, classes):
        a, b = v.first[k], v.first[k + 1]
        inside = log_softmax(states[rows] @ w["word"][a:b].T + w["word_bias"][a:b])
        scores[rows] += inside[np.arange(len(rows)), ids[rows] - a]
    return scores


def class_rows(v: Vocabulary, classes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of each class that has more than one member."""
    order = np.argsort(classes, kind="stable")
    bounds = np.searchsorted(classes[order], np.arange(len(v.first)))
    for k in range(len(v.first) - 1):
        if v.first[k + 1] - v.first[k] > 1 and bounds[k + 1] > bounds[k]:
            yield k, order[bounds[k] : bounds[k + 1]]


def train_window(w: dict, v: Vocabulary, ids: np.ndarray, begins: np.ndarray, state: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Gradients over one window (step, lane) of ids, of embeddings only for the ids in it; these ids; and the state after it."""
    steps, lanes = ids.shape
    x = w["embed"][ids]
    projected = x @ w["input"] + w["gate_bias"]
    states, trace = np.empty((steps, lanes, HIDDEN), np.float32), []
    for t in range(steps):
        state = np.where(begins[t][:, None], np.float32(0), state)
        states[t] = state
        state, *kept = gru_step(w, projected[t], state)
        trace.append(kept)
    flat, targets = states.reshape(-1, HIDDEN), ids.reshape(-1)
    classes = v.class_of[targets]
    each = np.arange(len(targets))
    error = softmax(flat @ w["class"] + w["class_bias"])
    error[each, classes] -= 1
    grads = {"class": flat.T @ error, "class_bias": error.sum(axis=0), "word": np.zeros_like(w["word"]), "word_bias": np.zeros_like(w["word_bias"])}
    back = error @ w["class"].T
    for k, rows in class_rows(v, classes):
        a, b = v.first[k], v.first[k + 1]
        before = flat[rows]
        inside = softmax(before @ w["word"][a:b].T + w["word_bias"][a:b])
        inside[np.arange(len(rows)), targets[rows] - a] -= 1
        grads["word"][a:b] = inside.T @ before
        grads["word_bias"][a:b] = inside.sum(axis=0)
        back[rows] += inside @ w["word"][a:b]
    back = back.reshape(steps, lanes, HIDDEN)
    grads["state"] = np.zeros_like(w["state"])
    d_projected = np.empty_like(projected)
    d_state = np.zeros((lanes, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        keep, reset, inner, new = trace[t]
        d_new = d_state * (1 - keep) * (1 - new * new)
        d_keep = d_state * (states[t] - new) * keep * (1 - keep)
        d_reset = d_new * inner * reset * (1 - reset)
        d_projected[t] = np.concatenate([d_keep, d_reset, d_new], axis=1)
        d_recurrent = np.concatenate([d_keep, d_reset, d_new * reset], axis=1)
        grads["state"] += states[t].T @ d_recurrent
        d_state = d_state * keep + d_recurrent @ w["state"].T + back[t]
        d_state = np.where(begins[t][:, None], np.float32(0), d_state)
    d_flat = d_projected.reshape(-1, 3 * HIDDEN)
    grads["input"] = x.reshape(-1, HIDDEN).T @ d_flat
    grads["gate_bias"] = d_flat.sum(axis=0)
    read, place = np.unique(targets, return_inverse=True)
    grads["embed"] = np.zeros((len(read), HIDDEN), np.float32)
    np.add.at(grads["embed"], place, d_flat @ w["input"].T)
    return grads, read, state


def train_stream(w: dict, v: Vocabulary, ids: np.ndarray, begins: np.ndarray, squares: dict) -> None:
    """Trains in place on a stream of documents, cut into lanes; the state goes on from window to window."""
    lanes = min(TRAIN_LANES, max(1, len(ids) // WINDOW))
    length = len(ids) // lanes
    rest, rest_begins = ids[lanes * length :], begins[lanes * length :]
    ids = ids[: lanes * length].reshape(lanes, length).T
    begins = begins[: lanes * length].reshape(lanes, length).T.copy()
    begins[0] = True
    state = np.zeros((lanes, HIDDEN), np.float32)
    for at in range(0, length, WINDOW):
        grads, read, state = train_window(w, v, ids[at : at + WINDOW], begins[at : at + WINDOW], state)
        for name, grad in grads.items():
            rows = read if name == "embed" else slice(None)
            grad = np.clip(grad / min(lanes, GRADIENT_LANES), -1, 1)
            squares[name][rows] += grad * grad
            w[name][rows] -= RATE * grad / np.sqrt(squares[name][rows])
    if len(rest):  # fewer words than lanes
        train_stream(w, v, rest, rest_begins, squares)


def ids_of(v: Vocabulary, words: Words, places: np.ndarray) -> np.ndarray:
    """Model id of each word: its own, or the one of its other-word class."""
    return np.where(places < len(v.class_of) - FIRST_WORD, places + FIRST_WORD, 1 + other_class(words))


def with_ends(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with the end id after each, and where texts begin (and the last one ends)."""
    return np.insert(ids, first[1:], END), first + np.arange(len(first))


def spelling_cells(v: Vocabulary, words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (three symbols before, symbol) over the letters and the end of some words; and the word of each."""
    lengths = words.end[which] - words.start[which] + 1
    upto = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(which)), lengths)
    inside = np.arange(int(upto[-1]) if len(upto) else 0) - np.repeat(upto - lengths, lengths)
    at = words.start[which][owner] + inside
    last = inside == lengths[owner] - 1
    symbol = np.where(last, 0, v.letter[words.data[np.minimum(at, len(words.data) - 1)]]) if len(at) else at
    cells = symbol.copy()
    for back in (1, 2, 3):
        before = np.zeros(len(symbol), np.int64)
        before[back:] = symbol[:-back] if back < len(symbol) else symbol[:0]
        cells += np.where(inside >= back, before, 0) * LETTERS**back
    return cells, owner


def train_batches(shared: Broadcast):
    """Trains from the shared weights on the documents of the task; hands on weights times words, and words.

    Also counts the spelling of the words that are not among the known ones.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, start = shared.value
        w = {name: value.copy() for name, value in start.items()}
        squares = {name: np.full(value.shape, 0.1, np.float32) for name, value in w.items()}
        cells = np.zeros(LETTERS**4, np.int64)
        stream, begins, held, seen = [], [], 0, 0
        for batch in batches:
            for part in pieces(batch, "text"):
                words = split_words(part.column("text"))
                hashes = word_hashes(words)
                places = v.index.places(hashes)
                _, first = np.unique(hashes[places == len(v.counts) - 1], return_index=True)
                found, _ = spelling_cells(v, words, np.flatnonzero(places == len(v.counts) - 1)[first])
                cells += np.bincount(found, minlength=len(cells))
                ids, at = with_ends(ids_of(v, words, places), words.first)
                fresh = np.zeros(len(ids), bool)
                fresh[at[:-1]] = True
                stream.append(ids)
                begins.append(fresh)
                held += len(ids)
                if held >= 200_000:
                    train_stream(w, v, np.concatenate(stream), np.concatenate(begins), squares)
                    stream, begins, seen, held = [], [], seen + held, 0
        if held:
            train_stream(w, v, np.concatenate(stream), np.concatenate(begins), squares)
            seen += held
        out = {f"w/{name}": np.round(value.ravel().astype(np.float64) * seen * FIXED_POINT).astype(np.int64) for name, value in w.items()} if seen else {}
        yield block_batch({**out, "seen": np.array([seen]), "cells": cells})

    return rows


def spelling_model(cells: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Log10-probability of a symbol after three others, smoothed with two, one and none; a byte of the last symbol
    shares with the other such bytes."""
    counts = cells.reshape([LETTERS] * 4).astype(np.float64)
    lower = np.full(LETTERS, 1 / LETTERS)
    for order in range(4):
        own = counts.sum(axis=tuple(range(3 - order)))
        total = own.sum(axis=-1, keepdims=True)
        kinds = (own > 0).sum(axis=-1, keepdims=True) + 1.0
        lower = (own + kinds * lower) / (total + kinds)
    logs = np.log10(lower)
    logs[..., LETTERS - 1] -= np.log10(max(int((letter == LETTERS - 1).sum()), 1))
    return logs.ravel().astype(np.float32)


class Scorer(NamedTuple):
    """All that scoring needs."""

    v: Vocabulary
    weights: dict
    spelling: np.ndarray

    def other_score(self, counts, spelled, other):
        """Log10-probability of words inside their other-word class: discounted counts, the rest by spelling."""
        words, types = np.maximum(self.v.other_words, 0)[other], np.maximum(self.v.other_types, 0)[other]
        spread = np.where(words > 0, DISCOUNT * types / np.maximum(words, 1), 1.0)
        share = (types + 1) / (self.v.other_types.sum() + OTHER)
        plain = np.maximum(counts - DISCOUNT, 0) / np.maximum(words, 1)
        return np.log10(plain + spread * 10.0 ** np.minimum(spelled - np.log10(share), 0.0) + 1e-300)


SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
    "rare array<struct<hash:bigint,spelled:float,other:int>>"
)
RARE = pa.struct([("hash", pa.int64()), ("spelled", pa.float32()), ("other", pa.int32())])


def recurrent_scores(s: Scorer, texts: list[np.ndarray]) -> np.ndarray:
    """Log10-probability of each sequence of ids, all side by side in windows with the state carried over."""
    v, w = s.v, s.weights
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    at = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.concatenate(texts)
    begins, sizes = at[:-1][order], lengths[order]
    table = w["embed"] @ w["input"] + w["gate_bias"]
    state = np.zeros((len(texts), HIDDEN), np.float32)
    total = np.zeros(len(texts))
    alive = np.searchsorted(-sizes, -np.arange(int(sizes[0])), "left")
    for begin in range(0, int(sizes[0]), WINDOW):
        seen, said, lane = [], [], []
        for t in range(begin, min(begin + WINDOW, int(sizes[0]))):
            m = alive[t]
            ids = flat[begins[:m] + t]
            seen.append(state[:m].copy())
            said.append(ids)
            lane.append(np.arange(m))
            state[:m] = gru_step(w, table[ids], state[:m])[0]
        lane = np.concatenate(lane)
        scores = output_scores(w, v, np.concatenate(seen), np.concatenate(said))
        total[: alive[begin]] += np.bincount(lane, weights=scores, minlength=alive[begin])
    out = np.empty(len(texts))
    out[order] = total / np.log(10)
    return out


def score_batches(shared: Broadcast):
    """Per document its scores as far as the known words go, and the words whose counts a join has to find."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s: Scorer = shared.value
        v = s.v
        none = len(v.counts) - 1
        smooth = np.log10(v.total + v.distinct + 1)
        parts: list[pa.RecordBatch] = []
        texts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            done = pa.concat_batches(parts) if len(parts) > 1 else parts[0]
            score = done.column("score").to_numpy() + recurrent_scores(s, texts)
            at = done.schema.get_field_index("score")
            return done.set_column(at, "score", pa.array(score))

        for batch in batches:
            for part in pieces(batch, "text"):
                words = split_words(part.column("text"))
                places = v.index.places(word_hashes(words))
                n = part.num_rows
                text_of = np.repeat(np.arange(n), np.diff(words.first))
                ids, at = with_ends(ids_of(v, words, places), words.first)
                texts.extend(ids[at[i] : at[i + 1]].astype(np.int32) for i in range(n))
                known = places < none
                counts = v.counts[places]
                base = np.bincount(text_of[known], weights=np.log10(counts[known] + 1) - smooth, minlength=n)
                base = base + np.log10(v.ends + 1) - smooth
                # Words without an embedding also have a cost inside their class.
                apart = np.flatnonzero(places >= len(v.class_of) - FIRST_WORD)
                cells, owner = spelling_cells(v, words, apart)
                spelled = np.bincount(owner, weights=s.spelling[cells], minlength=len(apart))
                other = other_class(Words(words.data, words.start[apart], words.end[apart], words.first))
                told = known[apart]
                inside = s.other_score(counts[apart][told], spelled[told], other[told])
                score = np.bincount(text_of[apart][told], weights=inside, minlength=n).astype(float)
                rare = apart[~told]
                hashes = word_hashes(words)[rare].view(np.int64)
                bounds = np.searchsorted(text_of[rare], np.arange(n + 1)).astype(np.int32)
                structs = pa.StructArray.from_arrays(
                    [pa.array(hashes), pa.array(spelled[~told].astype(np.float32)), pa.array(other[~told].astype(np.int32))], fields=list(RARE)
                )
                columns = {
                    "doc_id": part.column("doc_id"),
                    "held_out": part.column("held_out"),
                    "n_tokens": pa.array(np.diff(words.first) + 1),
                    "n_known": pa.array(np.bincount(text_of[known], minlength=n) + int(v.ends > 0)),
                    "base_score": pa.array(base),
                    "score": pa.array(score),
                    "rare": pa.ListArray.from_arrays(pa.array(bounds), structs),
                }
                parts.append(pa.RecordBatch.from_arrays(list(columns.values()), list(columns)))
                held += len(ids)
                if held >= HELD_WORDS:
                    yield flush()
                    parts, texts, held = [], [], 0
        if parts:
            yield flush()

    return rows


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def fit(spark: SparkSession, training: DataFrame) -> tuple[Scorer, DataFrame]:
    """The model, and the counts of all words as a written table (hash, n)."""
    counted = training.mapInArrow(count_words, WORD_COUNTS)
    counts = materialize(counted.groupBy("kind", "hash").agg(F.sum("n").alias("n"), F.first("other").alias("other")))
    vocabulary = build_vocabulary(counts, training.count())
    weights, cells = initial_weights(vocabulary), np.zeros(LETTERS**4, np.int64)
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast((vocabulary, weights))
        sums = summed_tables(training.filter(turn == number).select("text").mapInArrow(train_batches(shared), COUNTED))
        cells += filled(sums.get("cells", {}), len(cells))
        seen = int(filled(sums.get("seen", {}), 1)[0])
        if seen:
            weights = {
                name: (filled(sums.get(f"w/{name}", {}), value.size) / (seen * FIXED_POINT)).astype(np.float32).reshape(value.shape)
                for name, value in weights.items()
            }
    spelling = spelling_model(cells, vocabulary.letter)
    return Scorer(vocabulary, weights, spelling), counts.filter("kind = 0").select("hash", "n")


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    model, counts = fit(spark, source.filter(~F.col("held_out")).select("doc_id", "text"))
    v = model.v
    first = source.mapInArrow(score_batches(spark.sparkContext.broadcast(model)), SCORED)
    first = materialize(first.withColumn("row", F.monotonically_increasing_id()))
    rare = first.select("row", F.explode("rare").alias("w")).select("row", "w.*").join(counts, "hash", "left")
    n = F.coalesce("n", F.lit(0))
    classes = [(int(a), int(b)) for a, b in zip(np.maximum(v.other_words, 0), np.maximum(v.other_types, 0), strict=True)]
    at = F.col("other") + 1
    words = F.element_at(F.array(*[F.lit(float(max(a, 1))) for a, _ in classes]), at)
    spread = F.element_at(F.array(*[F.lit(DISCOUNT * b / a if a else 1.0) for a, b in classes]), at)
    all_types = sum(b for _, b in classes) + OTHER
    share = F.element_at(F.array(*[F.lit(float(np.log10((b + 1) / all_types))) for _, b in classes]), at)
    spelled = F.pow(F.lit(10.0), F.least(F.col("spelled").cast("double") - share, F.lit(0.0)))
    inside = F.log10(F.greatest(n - DISCOUNT, F.lit(0.0)) / words + spread * spelled + F.lit(1e-300))
    smooth = float(np.log10(v.total + v.distinct + 1))
    sums = rare.groupBy("row").agg(
        F.sum(inside).alias("more"), F.sum(F.log10(n + 1) - smooth).alias("more_base"), F.count_if(n > 0).alias("more_known")
    )
    joined = first.drop("rare").join(sums, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(v.total).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
