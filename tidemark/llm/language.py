"""Language identification with spans: scripts narrow the candidates, per-word scores and a Viterbi pass label the words.

Learning counts, over all labelled documents, words and letter n-grams per language, hashed into two tables of fixed
size, so a model has a size that does not grow with the corpus. Each task counts its rows into such tables and hands on
one row per block of the table; Spark sums the blocks.

Prediction: the Unicode scripts of a word's letters leave only the languages that were seen with that script. Each word
gets a log-probability per language, from the word itself and from its letter n-grams. Viterbi finds the best sequence
of languages when each switch costs `SWITCH` nats; all texts of a batch are run side by side. Runs of words with one
label are the spans of mixed text; the document's language is the one whose words have most letters, its score the share
of them, tempered by the certainty: how far the words of all spans, whatever their language, are from the runner-up.

Defined results: a null text, or one without a letter, is `und` with score and certainty 0 and no spans; so is every text
when nothing could be learned. A text whose letters are all of scripts never seen in training gets the first language
with score and certainty 0. With one learned language every word of a known script is certain. Labels that are null are not
learned from. Repeated rows are counted and predicted each for itself, a null doc_id counts as one that is not held out.
Ties go to the first language by code point. Texts are read as a whole, in pieces of bounded size per task; one text is
the unit of memory. An empty table gives no rows. Further columns of the input are not read by the query; `identify`
returns its key columns and its results only, so nothing can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.counts import COUNTED, block_batch, filled, summed_tables
from tidemark.llm.tables import table
from tidemark.llm.textbytes import BYTE_VALUE, Words, mix, pieces, split_words, text_buffers, word_hashes

UNKNOWN = "und"
WORD_BITS = 18  # entries of the word table per language: 2**18
GRAM_BITS = 16  # entries of the n-gram table per language
SIZES = {"word": 1 << WORD_BITS, "gram": 1 << GRAM_BITS, "script": 64}  # of the tables per language
SWITCH = 6.0  # nats that a change of language costs
GRAM_WEIGHT = 0.5

# First code point of each range of letters, and its script. Between ranges: no letter.
SCRIPTS = ["none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "indic", "thai", "hangul", "kana", "han", "other"]
SCRIPT_RANGES = [
    (0x00, "none"), (0x41, "latin"), (0x5B, "none"), (0x61, "latin"), (0x7B, "none"), (0xAA, "latin"), (0xAB, "none"),
    (0xB5, "latin"), (0xB6, "none"), (0xBA, "latin"), (0xBB, "none"), (0xC0, "latin"), (0xD7, "none"), (0xD8, "latin"),
    (0xF7, "none"), (0xF8, "latin"), (0x2B9, "none"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"),
    (0x590, "none"), (0x5D0, "hebrew"), (0x600, "none"), (0x620, "arabic"), (0x660, "none"), (0x66E, "arabic"),
    (0x700, "other"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x2C00, "other"), (0x2E00, "none"), (0x3005, "han"),
    (0x3008, "none"), (0x3041, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "none"), (0x3400, "han"),
    (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "none"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
    (0xFE00, "none"), (0xFE70, "arabic"), (0xFEFF, "none"), (0xFF21, "latin"), (0xFF3B, "none"), (0xFF41, "latin"),
    (0xFF5B, "none"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "none"), (0x10000, "other"), (0x1F000, "none"),
    (0x20000, "han"), (0xE0000, "none"),
]
STARTS = np.array([start for start, _ in SCRIPT_RANGES])
CODES = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES], dtype=np.int8)


class Features(NamedTuple):
    """Per word: slot in the word table, number of letters, bit set of scripts; n-gram slots and the word of each."""

    words: Words
    slot: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray
    gram_slot: np.ndarray
    gram_word: np.ndarray


def letter_scripts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all code points in UTF-8 bytes, and the script code of each."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int64)
    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    code = np.where(size == 1, lead, lead & (0x7F >> size))
    for i in range(1, 4):
        more = np.flatnonzero(size > i)
        code[more] = (code[more] << 6) | (data[at[more] + i] & 0x3F)
    return at, CODES[np.searchsorted(STARTS, code, "right") - 1]


def features(texts: pa.Array) -> Features:
    words = split_words(texts)
    n = len(words.start)
    at, script = letter_scripts(words.data)
    letter = script > 0
    at, script = at[letter], script[letter]
    begun = np.zeros(len(words.data), np.int32)
    begun[words.start] = 1
    owner = np.cumsum(begun, dtype=np.int32)[at] - 1
    letters = np.bincount(owner, minlength=n)
    scripts = np.zeros(n, np.int64)
    for code in np.unique(script):
        scripts[owner[script == code]] |= 1 << int(code)
    slot = (word_hashes(words) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    # Letter n-grams: three neighbouring letters of one word, punctuation skipped, the word's edges as letters.
    value = np.zeros(len(at), np.uint64)
    ends = np.append(at[1:], len(words.data))
    value = BYTE_VALUE[words.data[at]] if len(at) else value
    for i in range(1, 4):
        inside = np.flatnonzero(ends - at > i)
        inside = inside[(words.data[at[inside] + i] & 0xC0) == 0x80]
        value[inside] = mix(value[inside]) + BYTE_VALUE[words.data[at[inside] + i]]
    edge = np.uint64(1)
    previous = np.roll(value, 1)
    following = np.roll(value, -1)
    if len(at):
        previous[np.append(True, owner[1:] != owner[:-1])] = edge
        following[np.append(owner[1:] != owner[:-1], True)] = edge
    gram = mix(mix(previous) * np.uint64(3) + mix(value) * np.uint64(5) + mix(following) * np.uint64(7))
    return Features(words, slot, letters, scripts, (gram >> np.uint64(64 - GRAM_BITS)).astype(np.int64), owner)


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's rows (lang, text): words, n-grams and scripts per language."""
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in pieces(batch, "text"):
            found = features(part.column("text"))
            lang = np.array(part.column("lang").to_pylist(), dtype=object)
            of_word = np.repeat(np.arange(part.num_rows), np.diff(found.words.first))
            for name in sorted(set(lang)):
                mine = (lang == name)[of_word]
                spoken = mine & (found.letters > 0)
                for kind, size in SIZES.items():
                    tables.setdefault(f"{kind}/{name}", np.zeros(size, np.int64))
                tables[f"word/{name}"] += np.bincount(found.slot[spoken], minlength=SIZES["word"])
                tables[f"gram/{name}"] += np.bincount(found.gram_slot[mine[found.gram_word]], minlength=SIZES["gram"])
                for bit in range(len(SCRIPTS)):
                    tables[f"script/{name}"][bit] += int(((found.scripts[spoken] >> bit) & 1).sum())
    yield block_batch(tables)


class Model(NamedTuple):
    langs: list[str]
    word: np.ndarray  # slot, language: log-probability
    gram: np.ndarray
    allowed: np.ndarray  # script, language: 0, or minus infinity for a language never seen with it


def train(labelled: DataFrame) -> Model:
    """Counts of all rows (lang, text); the model has a fixed size per language."""
    counted = labelled.select("lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count_batches, COUNTED)
    found = summed_tables(counted)
    langs = sorted({name.partition("/")[2] for name in found})
    word, gram, script = (
        np.stack([filled(found.get(f"{kind}/{name}", {}), size) for name in langs], axis=1) if langs else np.zeros((size, 0))
        for kind, size in SIZES.items()
    )
    logs = []
    for counts in (word, gram):
        seen = counts.sum(axis=0)
        logs.append(np.log((counts + 0.5) / (seen + 0.5 * len(counts))).astype(np.float32))
    # A script counts as a language's own from a ten-thousandth of its words on.
    own = script >= np.maximum(script.sum(axis=0) * 1e-4, 1)
    return Model(langs, *logs, np.where(own, 0.0, -np.inf).astype(np.float32))


def word_scores(found: Features, model: Model) -> np.ndarray:
    """Log-probability of each word in each language, after the languages its scripts rule out."""
    n, k = len(found.slot), len(model.langs)
    scores = model.word[found.slot].copy()
    sums = np.empty((n, k), np.float32)
    for j in range(k):
        sums[:, j] = np.bincount(found.gram_word, weights=model.gram[found.gram_slot, j], minlength=n)
    scores += GRAM_WEIGHT * sums
    scores[found.letters == 0] = 0
    for bit in range(1, len(SCRIPTS)):
        has = (found.scripts >> bit) & 1 == 1
        if bit > 1 and not has.any():
            continue
        # A script that no language has rules nothing out; its words just say nothing.
        if np.isinf(model.allowed[bit]).all():
            scores[has & (found.scripts == 1 << bit)] = 0
        else:
            scores[has] += model.allowed[bit]
    lost = np.isinf(scores).all(axis=1)
    scores[lost] = 0
    return scores


def viterbi(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best language per word of each text, all texts side by side. A switch costs SWITCH."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = first[:-1][order], lengths[order]
    k = scores.shape[1]
    labels = np.zeros(len(scores), np.int8)
    back = np.zeros((len(scores), k), np.int8)
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t words
    best = np.zeros((len(sizes), k), np.float32)
    own = np.arange(k, dtype=np.int8)
    for t in range(longest):
        m = alive[t]
        at = begins[:m] + t
        value = best[:m]
        if t:
            leader = value.argmax(axis=1)
            top = value[np.arange(m), leader] - SWITCH
            stay = value >= top[:, None]
            back[at] = np.where(stay, own, leader[:, None].astype(np.int8))
            value = np.where(stay, value, top[:, None])
        best[:m] = value + scores[at]
        if (t & 255) == 255:
            best[:m] -= best[:m].max(axis=1, keepdims=True)
    state = best.argmax(axis=1).astype(np.int8) if k else np.zeros(len(sizes), np.int8)
    for t in range(longest - 1, -1, -1):
        m = alive[t]
        at = begins[:m] + t
        labels[at] = state[:m]
        state[:m] = back[at, state[:m]] if t else state[:m]
    return labels


SPANS = "array<struct<lang:string,first_word:int,n_words:int>>"


def predict_batches(model: Model, keys: list[str], text: str):
    """Function for mapInArrow: rows with the keys and the text to (keys, lang_pred, score, certainty, spans)."""
    names = np.array([*model.langs, UNKNOWN], dtype=object)
    kinds = pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("n_words", pa.int32())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, text):
                found = features(part.column(text))
                first, n, k = found.words.first, part.num_rows, len(model.langs)
                text_of = np.repeat(np.arange(n), np.diff(first))
                known = np.array([not np.isinf(model.allowed[b]).all() for b in range(len(SCRIPTS))]) if k else np.zeros(len(SCRIPTS), bool)
                usable = (found.scripts & sum(1 << b for b in range(1, len(SCRIPTS)) if known[b])) > 0
                if k:
                    scores = word_scores(found, model)
                    labels = viterbi(scores, first)
                    weights = np.where(usable, found.letters, 0)
                    share = np.bincount(text_of * k + labels, weights=weights, minlength=n * k).reshape(n, k)
                    best = share.argmax(axis=1)
                    total = share.sum(axis=1)
                    part_of = share.max(axis=1) / np.maximum(total, 1)
                    # Mean lead per word of the label over the other languages, as a probability.
                    rest = scores.copy()
                    rest[np.arange(len(rest)), labels] = -np.inf
                    lead = scores[np.arange(len(rest)), labels] - rest.max(axis=1) if k > 1 else np.full(len(rest), 20.0)
                    lead = np.bincount(text_of, weights=np.where(usable, np.clip(lead, -20, 20), 0), minlength=n)
                    sure = np.where(total > 0, 1 / (1 + np.exp(-np.clip(lead, -30, 30))), 0.0)
                    spoken = np.bincount(text_of, weights=found.letters, minlength=n) > 0
                    pred = np.where(spoken, best, k)
                    score = part_of * sure
                else:
                    labels, pred, score, sure = np.zeros(len(text_of), np.int8), np.full(n, 0), np.zeros(n), np.zeros(n)
                change = np.ones(len(labels), bool)
                change[1:] = (labels[1:] != labels[:-1]) | (text_of[1:] != text_of[:-1])
                heads = np.flatnonzero(change)
                heads = heads[pred[text_of[heads]] < k] if k else heads[:0]
                run = np.diff(np.append(np.flatnonzero(change), len(labels)))
                run = run[np.searchsorted(np.flatnonzero(change), heads)]
                spans = pa.StructArray.from_arrays(
                    [
                        pa.array(names[labels[heads]], pa.string()),
                        pa.array(heads - first[:-1][text_of[heads]], pa.int32()),
                        pa.array(run, pa.int32()),
                    ],
                    fields=list(kinds),
                )
                bounds = np.searchsorted(text_of[heads], np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keys]
                    + [
                        pa.array(names[pred], pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(sure, pa.float64()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans),
                    ],
                    [*keys, "lang_pred", "score", "certainty", "spans"],
                )

    return predict


def identify(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """Per row of `docs`: its key columns, lang_pred, score, certainty and spans (runs of words of one language)."""
    chosen = docs.select(*keys, *([] if text in keys else [text]))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keys).schema]
    made = ["lang_pred string", "score double", "certainty double", f"spans {SPANS}"]
    return chosen.mapInArrow(predict_batches(model, keys, text), ", ".join([*types, *made]))


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model:
    return train(docs.filter(~held_out(F.col("doc_id"))))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, learn(docs), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "certainty", "spans")
