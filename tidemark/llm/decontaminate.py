"""Benchmark decontamination by templates: benchmark questions in documents, also with other numbers, names or units.

1. Canonical tokens. Words lose case and outer punctuation. A word with a digit becomes the placeholder NUMBER, a unit
   after a number UNIT, a capitalised word inside a sentence NAME; the word itself is kept as the value of the slot. A
   capitalised word that opens a sentence may be a name or not, unless it is one of `OPENERS`: it is read in both ways.
2. Windows of `WINDOW` tokens are hashed, as they are and, if they have slots, as templates of either reading (unless too
   few plain words are left to tell one template from another). An item with fewer tokens is one window of its own length.
   An item with windows that are too rich in slots, or that is too short, for a template also is one template as a whole;
   with fewer than `MIN_PLAIN` plain words it is only found where it stands as sentences of its own, and with none never.
3. Document windows pass a filter of fixed size made from the item windows, so almost none leave the task they are read
   in; those that pass meet the item windows in an exact hash join.
4. Slots must be consistent: along one alignment of item and document, an item's value (say 7, or Anna) has to stand for
   one and the same value of the document everywhere. Windows with a value that breaks this do not count.
5. A document holds an item if at least `COVERAGE` of the item's windows are found in it, or of those that can be compared
   (the ones without slots or with a template), or if the whole item is found.

Defined results: null or empty texts, and items without words, match nothing. Repeated document rows are one document
(same doc_id and text); items that repeat are found each under its own id. A null doc_id is reported as null. Empty
documents or an empty benchmark give no rows. Of the inputs only ids and texts are read by `contaminated`;
`without_contaminated` keeps all columns of the documents. Texts are read as a whole; one text is the unit of memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.counts import bit_filter, has_bit
from tidemark.llm.tables import table
from tidemark.llm.textbytes import BASE, INVERSE, LOWER, SPACE, mix, pieces, powers, span_hashes, split_words, text_buffers, window_hashes
from tidemark.session import materialize

WINDOW = 8
MIN_PLAIN = 4  # plain words that a window needs to be compared as a template
COVERAGE = 0.5
FILTER_BITS = 24  # 2 MB

# Words that are units after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "g kg mg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce ounces l ml cl liter liters litre litres "
    "gallon gallons s sec min h hr hrs second seconds minute minutes hour hours day days week weeks month months year years "
    "c f k degree degrees percent pct dollar dollars cent cents euro euros usd eur gbp yen hz khz mhz ghz w kw v a ohm j kj "
    "kcal cal pa bar n b kb mb gb tb mph kmh kph sekunde sekunden minuten stunde stunden tag tage woche wochen monat monate "
    "jahr jahre seconde secondes heure heures jour jours semaine semaines mois an ans segundo segundos minuto minutos hora "
    "horas dia dias semana semanas mes meses metros litros litro kilo kilos prozent"
).split()
# Words that open sentences and are no names.
OPENERS = (
    "a about after all also although an and any are as at because been before both but by can could did do does during each "
    "every few find finally first for from give given had has have he her here his how however i if in is it its last let many "
    "may might most must my next no not now of on once one or our over please she should since so some such than that the "
    "their them then there these they this those through to today two under until was we were what when where whether which "
    "while who whom whose why will with would yes yet you your "
    "aber alle als am an auf aus bei das dass dein dem den der des die dies diese dieser doch du ein eine einem einen einer er "
    "es für hat haben ich ihr im in ist ja jede jeder kann mit nach nein nicht noch nun oder ohne sein seine sie sind so und "
    "um von vor wann warum was welche welcher wenn wer werden wie wieviel wir wird wo zu zum zur "
    "au aux avec ce cela ces cette chaque combien comment dans de des donc du elle elles en est et il ils je la le les leur "
    "lorsque mais mon ne nous on ou où par pas plus pour pourquoi quand que quel quelle quelles quels qui quoi sa se si son "
    "sont sur un une vous à "
    "al como con cual cuál cuando cuándo cuanto cuánto cuántos cuántas cada de del donde dónde el ella ellos en entre es esta "
    "este esto ha hay la las lo los mi muy no para pero por porque qué que quien quién se si sin sobre son su sus también un "
    "una uno y ya yo"
).split()
PLAIN, NUMBER, NAME, UNIT = 0, 1, 2, 3
KIND_HASH = mix(np.array([11, 12, 13, 14], np.uint64))

PUNCT = np.zeros(256, bool)
PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
WITHIN = np.zeros(256, bool)  # punctuation after which a sentence goes on
WITHIN[[ord(c) for c in ",-'\"()&/"]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the letters of Latin-1, which keep their length in UTF-8."""
    low = LOWER[data]
    after = np.flatnonzero(low[:-1] == 0xC3) + 1
    accented = after[(low[after] >= 0x80) & (low[after] <= 0x9E) & (low[after] != 0x97)]
    low[accented] += 0x20
    return low


class Tokens(NamedTuple):
    """Tokens of some texts in order; text i has tokens first[i] to first[i + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    kind: np.ndarray
    plain: np.ndarray  # hash of the word
    template: np.ndarray  # hash of the word or of its placeholder
    named: np.ndarray  # the kind if capitalised words that open a sentence are names
    opens: np.ndarray  # whether a sentence starts with the token

    def alone(self, at: np.ndarray, size: int) -> np.ndarray:
        """Whether windows begin and end where sentences do."""
        edge = np.append(self.opens, True)
        edge[self.first] = True
        return edge[at] & edge[at + size]


def listed_hashes(listed: list[str]) -> np.ndarray:
    words = split_words(pa.array([" ".join(listed)]))
    return np.unique(span_hashes(words.data, words.start, words.end))


def is_listed(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes


UNIT_HASHES, OPENER_HASHES = listed_hashes(UNITS), listed_hashes(OPENERS)


def canonical_tokens(texts: pa.Array) -> Tokens:
    raw, at = text_buffers(texts)
    words = split_words(texts)
    low = lower_bytes(raw)
    solid = ~(PUNCT[raw] | SPACE[raw])
    places = np.flatnonzero(solid)
    before = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(solid, out=before[1:])
    some = before[words.end] > before[words.start]
    # A sentence starts with a text or line, and after a word that ends in punctuation (or is nothing else).
    last = raw[words.end - 1] if len(words.end) else raw[:0]
    closes = PUNCT[last] & ~WITHIN[last]
    lines = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(raw == 10, out=lines[1:])
    opens = np.ones(len(words.start), bool)
    opens[1:] = closes[:-1] | (lines[words.start[1:]] != lines[words.start[:-1]])
    opens[words.first[:-1][words.first[:-1] < len(opens)]] = True
    opens |= PUNCT[raw[words.start]] & ~WITHIN[raw[words.start]] if len(words.start) else opens
    # What a word of punctuation only opens is opened for the next token too.
    opened = np.zeros(len(words.start) + 1, np.int64)
    np.cumsum(opens, out=opened[1:])
    first = np.zeros(len(words.start) + 1, np.int64)
    np.cumsum(some, out=first[1:])
    first = first[words.first]
    begin, stop, opens = words.start[some], words.end[some], opens[some]
    upto = opened[1:][some]
    starts = np.diff(upto, prepend=0) > 0
    start, end = places[before[begin]], places[before[stop] - 1] + 1
    plain = span_hashes(low, start, end)
    kind = np.zeros(len(start), np.int8)
    padded = np.append(raw, np.zeros(4, np.uint8))
    lead, second, third = padded[start], padded[start + 1], padded[start + 2]
    ascii_capital = (lead >= 65) & (lead <= 90)
    accented_capital = (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    follow = np.where(accented_capital, third, second)
    beyond = np.where(accented_capital, padded[start + 3], third)
    small = (follow >= 97) & (follow <= 122) | (follow > 0xC3) | (follow == 0xC3) & (beyond >= 0xA0)
    room = end - start > np.where(accented_capital, 2, 1)
    capital = (ascii_capital | accented_capital) & small & room
    kind[capital & ~opens] = NAME
    named = kind.copy()
    named[capital & ~is_listed(plain, OPENER_HASHES)] = NAME
    named[kind == NAME] = NAME
    digits = np.zeros(len(raw) + 1, np.int32)
    np.cumsum(DIGIT[raw], out=digits[1:])
    number = digits[end] > digits[start]
    kind[number] = named[number] = NUMBER
    if number.any():
        after = np.flatnonzero(number[:-1]) + 1
        unit = after[is_listed(plain[after], UNIT_HASHES) & (kind[after] != NUMBER)]
        unit = np.setdiff1d(unit, first[:-1])
        kind[unit] = named[unit] = UNIT
    return Tokens(low, start, end, first, kind, plain, np.where(kind > 0, KIND_HASH[kind], plain), named, starts)


def readings(tokens: Tokens) -> tuple[Tokens, Tokens]:
    """The tokens with capitalised words that open a sentence as plain words, and as names."""
    return tokens, tokens._replace(kind=tokens.named, template=np.where(tokens.named > 0, KIND_HASH[tokens.named], tokens.plain))


def slot_counts(tokens: Tokens, at: np.ndarray, size: int) -> np.ndarray:
    filled = np.zeros(len(tokens.kind) + 1, np.int32)
    np.cumsum(tokens.kind > 0, out=filled[1:])
    return filled[at + size] - filled[at]


def run_hashes(values: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` values from each place on, at the same cost for any size."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), dtype=np.uint64, out=total[1:])
    return mix((total[at + size] - total[at]) * powers(INVERSE, len(values) + 1)[at])


def windows(tokens: Tokens, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First tokens of all windows inside a text, their hashes, and their readings: each window as its words are (-1), and
    each one with slots and enough plain words as a template of the first (0) and, if it differs, of the second reading (1).

    With `whole` only templates, as for items as a whole: there some plain word is enough for sentences that stand alone.
    """
    n = len(tokens.start) - size + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none.astype(np.uint64), none
    text = np.repeat(np.arange(len(tokens.first) - 1), np.diff(tokens.first))
    at = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :])
    begins, hashes, kinds = ([none], [none.astype(np.uint64)], [none]) if whole else ([at], [~window_hashes(tokens.plain, size)[at]], [np.full(len(at), -1)])
    salt = np.uint64(size + (1 << 32 if whole else 0))
    before = 0
    for number, read in enumerate(readings(tokens)):
        slots = slot_counts(read, at, size)
        enough = size - slots >= MIN_PLAIN
        if whole:
            enough |= (size > slots) & tokens.alone(at, size)
        template = at[(slots > before) & enough]
        before = slots
        begins.append(template)
        hashes.append(run_hashes(read.template, template, size) if whole else window_hashes(read.template, size)[template])
        kinds.append(np.full(len(template), number))
    return np.concatenate(begins), np.concatenate(hashes) + salt, np.concatenate(kinds)


def slot_values(tokens: Tokens, at: int, size: int) -> list[str]:
    """Values of a window's slots in order, each with its kind."""
    slots = np.flatnonzero(tokens.kind[at : at + size]) + at
    names = "pnau"
    return [names[tokens.kind[i]] + tokens.data[tokens.start[i] : tokens.end[i]].tobytes().decode("utf-8", "replace") for i in slots]


WINDOW_ROWS = "item_id bigint, item_windows int, comparable_windows int, size int, whole boolean, comparable boolean, at int, window bigint, slots array<string>"


def item_batches(size: int):
    """All windows of benchmark items."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tokens = canonical_tokens(part.column("text"))
                read = readings(tokens)
                out = []
                for i, item in enumerate(part.column("item_id").to_pylist()):
                    first, last = int(tokens.first[i]), int(tokens.first[i + 1])
                    own = min(last - first, size)
                    if not own:
                        continue
                    at, hashes, kinds = windows(tokens, own)
                    mine = (at >= first) & (at < last)
                    at, hashes, kinds = at[mine], hashes[mine], kinds[mine]
                    places = np.arange(first, last - own + 1)
                    fixed = slot_counts(tokens, places, own) == 0
                    comparable = set(at[kinds >= 0].tolist()) | set(places[fixed].tolist())
                    found = [(False, *row) for row in zip(at.tolist(), hashes.view(np.int64).tolist(), kinds.tolist(), strict=True)]
                    # Windows that no template can stand for, in one of the readings.
                    poor = any((((n := slot_counts(r, places, own)) > 0) & (own - n < MIN_PLAIN)).any() for r in read)
                    if poor:
                        at, hashes, kinds = windows(tokens, last - first, whole=True)
                        mine = at == first
                        found += [(True, *row) for row in zip(at[mine].tolist(), hashes[mine].view(np.int64).tolist(), kinds[mine].tolist(), strict=True)]
                    for whole, a, h, kind in found:
                        length = last - first if whole else own
                        values = slot_values(read[kind], a, length) if kind >= 0 else []
                        out.append((item, last - first - own + 1, len(comparable), length, whole, a in comparable, a - first, h, values))
                if out:
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.int32(), pa.int64(), pa.list_(pa.string())]
                    names = ["item_id", "item_windows", "comparable_windows", "size", "whole", "comparable", "at", "window", "slots"]
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows


FOUND_ROWS = "doc_id bigint, text_hash bigint, doc_at int, window bigint, doc_slots array<string>"


def document_batches(sizes: list[tuple[int, bool]], bits: Broadcast):
    """Windows of documents that pass the filter. Of equal windows without slots in one document, the first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tokens = canonical_tokens(part.column("text"))
                read = readings(tokens)
                ids, codes = part.column("doc_id").to_pylist(), part.column("text_hash").to_pylist()
                out, seen = [], set()
                for size, whole in sizes:
                    at, hashes, kinds = windows(tokens, size, whole)
                    hit = np.flatnonzero(has_bit(bits.value, hashes, FILTER_BITS))
                    text = np.searchsorted(tokens.first, at[hit], "right") - 1
                    for a, h, kind, i in zip(at[hit], hashes[hit].view(np.int64), kinds[hit], text, strict=True):
                        values = slot_values(read[kind], a, size) if kind >= 0 else []
                        if not values:
                            if (i, h) in seen:
                                continue
                            seen.add((i, h))
                        out.append((ids[i], codes[i], int(a - tokens.first[i]), int(h), values))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())]
                    names = ["doc_id", "text_hash", "doc_at", "window", "doc_slots"]
                    columns = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows


def contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it holds: doc_id, text_hash, item_id, coverage, n_windows, n_changed (slot values)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    known = materialize(items.mapInArrow(item_batches(size), WINDOW_ROWS))
    sizes = sorted((r["size"], r.whole) for r in known.select("size", "whole").distinct().collect())  # one row per length of an item at most, and `size`
    bits = spark.sparkContext.broadcast(bit_filter(known, "window", FILTER_BITS))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    found = source.mapInArrow(document_batches(sizes, bits), FOUND_ROWS)
    met = materialize(found.join(known, "window"))
    key = ["doc_id", "text_hash", "item_id"]
    group = [F.coalesce("doc_id", F.lit(-1)).alias("k"), F.col("doc_id").isNull().alias("unnamed"), "text_hash", "item_id"]
    met = met.select(*group, "doc_id", "item_windows", "comparable_windows", "whole", "comparable", "at", (F.col("doc_at") - F.col("at")).alias("shift"), F.arrays_zip("slots", "doc_slots").alias("pairs"))
    names = ["k", "unnamed", "text_hash", "item_id"]
    # Values of an item that stand for two values of the document along one alignment.
    values = met.select(*names, "shift", F.explode("pairs").alias("pair")).distinct()
    broken = values.groupBy(*names, "shift", F.col("pair.slots").alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    broken = broken.groupBy(*names, "shift").agg(F.collect_set("value").alias("broken"))  # at most an item's values
    checked = met.join(broken, [*names, "shift"], "left")
    values_of = F.transform("pairs", lambda p: p["slots"])
    whole = checked.filter(F.col("broken").isNull() | ~F.arrays_overlap(values_of, F.col("broken")))
    changed = F.size(F.filter("pairs", lambda p: p["slots"] != p["doc_slots"]))
    share = F.count_distinct("at") / F.max("item_windows")
    alike = F.count_distinct(F.when(F.col("comparable"), F.col("at"))) / F.nullif(F.max("comparable_windows"), F.lit(0))
    # An item that stands twice in the table under one id is one item with the windows of both.
    scored = whole.groupBy(*names).agg(
        F.first("doc_id").alias("doc_id"),
        F.when(F.bool_or("whole"), F.greatest(share, F.lit(1.0))).otherwise(F.greatest(share, alike)).alias("coverage"),
        F.when(F.bool_or("whole"), F.max("item_windows").cast("bigint")).otherwise(F.count_distinct("at")).alias("n_windows"),
        F.max(changed).alias("n_changed"),
    )
    return scored.filter(F.col("coverage") >= coverage).select(*key, "coverage", "n_windows", "n_changed")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(bad, same, "left_anti")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash").distinct()
