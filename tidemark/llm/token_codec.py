"""Token ids in binary files: an adaptive context-mixing range coder in independent, checksummed blocks.

Layout. Documents are put in ascending doc_id by ranges, so each task writes one run of them. A run is a sequence of
chunks (rows of a Parquet table: number of ids before the chunk in its run, the documents' ids and lengths, blocks); a
document never spans chunks. A chunk's ids are cut into blocks of equal length. A block is a byte string

    "TMX1" | mode u8 | number of ids u32 | crc32 of the ids u32 | bytes of payload u32 | payload      (little-endian)

with mode 1 for coded and 0 for plain ids (u32), used where coding would not save anything. Every block starts from the
same model state, so any block can be read alone; a wrong checksum is an error.

Model. The order-2 and the order-1 context (hashed) each predict one id, with a confidence. Whether the order-2
prediction is right is coded with a probability mixed in the logistic domain from the confidence of order 2, that of
order 1 and whether both agree, with weights that learn as they go. If not, whether order 1 is right; if not, the id is
coded at order 0: the number of its bits (by adaptive frequencies that know the previous id's), its four leading bits
below the first (by adaptive frequencies for that number), the rest as they are. All
arithmetic is on whole numbers, so every machine decodes alike. All blocks of a chunk are coded side by side, one id of
each per step.

Defined results: a null or empty text has the end id only. A null doc_id comes first. Repeated rows are documents of
their own; rows with one doc_id are ordered by their text. An empty table gives no rows. Of the input only doc_id and
text are read. A text longer than a chunk is a chunk of its own; one text is the unit of memory.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import table
from tidemark.llm.textbytes import Words, pieces, span_hashes, split_words, text_buffers, word_text
from tidemark.session import materialize

END_ID = 1  # fixed value of the query
CHUNK_IDS = 3_000_000
BLOCK_IDS = 4096
MIN_BLOCK_IDS = 1024
LANES = 2048  # blocks that are coded side by side, and that a chunk is cut into
MAX_ID_BITS = 20
HEADER = "<4sBIII"
CACHED_WORDS = 200_000

CONTEXT_BITS = 11  # entries of an order's table per block: 2**11
TOP = np.uint64(32)
ONE = np.uint64(1)
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
LOW = np.uint64(0xFFFFFFFF)
RATE = 4


def squash_table() -> np.ndarray:
    """Probability of 4096 at each point d of the logistic domain, d from -2048 to 2047 in 1/256."""
    import math

    return np.array([min(4095, max(1, round(4096 / (1 + math.exp(-d / 256))))) for d in range(-2048, 2048)], np.int32)


def stretch_table(squash: np.ndarray) -> np.ndarray:
    """Its inverse by table: the least point whose probability is at least p."""
    return (np.searchsorted(squash, np.arange(4096)) - 2048).clip(-2047, 2047).astype(np.int32)


SQUASH = squash_table()
STRETCH = stretch_table(SQUASH)


class Lanes:
    """Coding intervals [low, high] of some blocks, and what was written or is read of each."""

    def __init__(self, low, high, code, at, stream, which, decode):
        self.low, self.high, self.code, self.at = low, high, code, at
        self.stream, self.which, self.decode = stream, which, decode

    def some(self, sel: np.ndarray) -> Lanes:
        code = self.code[sel] if self.decode else None
        return Lanes(self.low[sel], self.high[sel], code, self.at[sel], self.stream, self.which[sel], self.decode)

    def put(self, sel: np.ndarray, part: Lanes) -> None:
        self.low[sel], self.high[sel], self.at[sel] = part.low, part.high, part.at
        if self.decode:
            self.code[sel] = part.code

    def bit(self, p: np.ndarray, bit: np.ndarray | None) -> np.ndarray:
        """Codes one bit per lane; p is the probability of 4096 that it is set."""
        p = np.clip(p, 32, 4064).astype(np.uint64)
        middle = self.low + ((self.high - self.low) >> np.uint64(12)) * p
        if self.decode:
            bit = self.code <= middle
        self.high = np.where(bit, middle, self.high)
        self.low = np.where(bit, self.low, middle + ONE)
        return bit

    def plain(self, bits: np.ndarray, value: np.ndarray | None) -> np.ndarray:
        """Codes a number of the given bits, all values alike."""
        bits = bits.astype(np.uint64)
        part = (self.high - self.low) >> bits
        if self.decode:
            value = np.minimum((self.code - self.low) // part, (ONE << bits) - ONE)
        value = value.astype(np.uint64)
        self.low = self.low + part * value
        self.high = self.low + part - ONE
        return value.astype(np.int64)

    def write(self, which: np.ndarray, at: np.ndarray, word: np.ndarray) -> None:
        """Writes a word per lane; what does not fit lands on the last place, and the count tells so."""
        self.stream[which, np.minimum(at, self.stream.shape[1] - 1)] = word

    def finish(self, sel: np.ndarray) -> None:
        """Writes a number inside the interval."""
        if not self.decode:
            self.write(self.which[sel], self.at[sel], self.low[sel] >> TOP)
            self.write(self.which[sel], self.at[sel] + 1, self.low[sel] & LOW)

    def shift(self) -> None:
        """Moves out the upper 32 bits of intervals that have become small. Afterwards none is under 2**32.

        An interval that straddles a multiple of 2**32 is cut to its larger side first, so that its upper bits agree.
        """
        small = np.flatnonzero((self.high - self.low) < LOW)
        if not len(small):
            return
        low, high = self.low[small], self.high[small]
        border = (high >> TOP) << TOP
        split = (low >> TOP) != (high >> TOP)
        upper = split & (high - border >= border - low)
        high = np.where(split & ~upper, border - ONE, high)
        low = np.where(upper, border, low)
        which, at = self.which[small], self.at[small]
        if self.decode:
            word = self.stream[which, np.minimum(at + 2, self.stream.shape[1] - 1)]  # a damaged block may ask for more
            self.code[small] = (self.code[small] << TOP) | word.astype(np.uint64)
        else:
            self.write(which, at, low >> TOP)
        self.at[small] = at + 1
        self.low[small], self.high[small] = low << TOP, (high << TOP) | LOW


def learn(table: np.ndarray, at: np.ndarray, p: np.ndarray, bit: np.ndarray) -> None:
    """Moves the 16-bit probabilities p, found at `at`, towards the bits."""
    table[at] = p + ((bit * 65535 - p) >> RATE)


# Where the cumulative frequencies of 16 symbols move to when a symbol was seen: one apart, the rest at the symbol.
TARGETS = np.array([[i + (32768 - 16 if i > s else 0) for i in range(16)] for s in range(16)], np.int16)
EVEN = (np.arange(16) * 2048).astype(np.int16)


def symbol(lanes: Lanes, rows: np.ndarray, value: np.ndarray | None) -> np.ndarray:
    """Codes one of 16 symbols per lane by its row of cumulative frequencies of 32768."""
    part = (lanes.high - lanes.low) >> np.uint64(15)
    if lanes.decode:
        place = np.minimum((lanes.code - lanes.low) // part, np.uint64(32767)).astype(np.int16)
        value = (rows <= place[:, None]).sum(axis=1) - 1
    each = np.arange(len(rows))
    below = rows[each, value]
    above = np.where(value < 15, rows[each, np.minimum(value + 1, 15)].astype(np.int32), 32768)
    lanes.high = lanes.low + part * above.astype(np.uint64) - ONE
    lanes.low = lanes.low + part * below.astype(np.uint64)
    return value


def code_ids(lengths: np.ndarray, ids: np.ndarray | None, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes blocks side by side; lengths must not rise. With ids encodes into `stream` (block, u32), else decodes it.

    Returns the ids (block, position), and the number of words written per block (more than fit: does not fit).
    """
    blocks, steps = len(lengths), int(lengths[0])
    decode = ids is None
    if decode:
        ids = np.zeros((blocks, steps), np.int32)
        code = (stream[:, 0].astype(np.uint64) << TOP) | stream[:, 1].astype(np.uint64)
    else:
        code = None
    zero = np.zeros(blocks, np.uint64)
    lane = np.arange(blocks)
    lanes = Lanes(zero.copy(), zero + FULL, code, np.zeros(blocks, np.int64), stream, lane, decode)
    alive = np.searchsorted(-lengths, -np.arange(steps), "left")
    entries = 1 << CONTEXT_BITS
    guess2, guess1 = np.zeros(blocks * entries, np.int32), np.zeros(blocks * entries, np.int32)
    sure2, sure1 = np.zeros(blocks * entries, np.int8), np.zeros(blocks * entries, np.int8)
    hit2, hit1 = np.full(blocks * 16, 32768, np.int32), np.full(blocks * 32, 32768, np.int32)
    next1 = np.full(blocks * 16, 32768, np.int32)
    mixer = np.full((3, blocks), 20000, np.int32)
    mixer[2] = 0
    size_rows = np.tile(EVEN, (blocks * 16, 1))
    lead_rows = np.tile(EVEN, (blocks * 16, 1))
    previous, before, previous_size = np.zeros(blocks, np.int64), np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
    done, words = blocks, np.zeros(blocks, np.int64)
    columns = None if decode else np.ascontiguousarray(ids.T)
    for t in range(steps):
        m = int(alive[t])
        if m < done:  # the blocks that go on are the first ones
            lanes.finish(lane[m:done])
            words[m:done] = lanes.at[m:] + 2
            lanes = lanes.some(lane[:m])
            previous, before, previous_size, done = previous[:m], before[:m], previous_size[:m], m
        own = lane[:m]
        true = None if decode else columns[t, :m]
        mixed1 = previous * 0x9E3779B1
        at2 = own * entries + (((mixed1 + before * 0x85EBCA6B) >> 11) & (entries - 1))
        at1 = own * entries + ((mixed1 >> 13) & (entries - 1))
        g2, g1, s2, s1 = guess2[at2], guess1[at1], sure2[at2], sure1[at1]
        same = g2 == g1
        # Is the prediction of order 2 right?
        i2, i1 = own * 16 + s2, own * 32 + (s1 * 2 + same)
        p2, p1 = hit2[i2], hit1[i1]
        x2, x1 = STRETCH[p2 >> 4], STRETCH[p1 >> 4]
        w2, w1, w0 = mixer[0, :m], mixer[1, :m], mixer[2, :m]
        p = SQUASH[np.clip((w2 * x2 + w1 * x1 + w0 * 256) >> 16, -2047, 2047) + 2048]
        right2 = lanes.bit(p, None if decode else true == g2)
        wrong = (right2 * 4096 - p) * 6
        np.clip(w2 + ((x2 * wrong + 8192) >> 14), -400_000, 400_000, out=w2)
        np.clip(w1 + ((x1 * wrong + 8192) >> 14), -400_000, 400_000, out=w1)
        np.clip(w0 + ((wrong + 4) >> 3), -400_000, 400_000, out=w0)
        learn(hit2, i2, p2, right2)
        learn(hit1, i1, p1, right2)
        found = g2.astype(np.int64)
        rest = np.flatnonzero(~right2)
        if len(rest):
            part = lanes.some(rest)
            part.shift()
            # Else that of order 1? Where both predict the same it is not, and the answer costs next to nothing.
            r1, j = g1[rest], rest * 16 + s1[rest]
            pj = next1[j]
            right1 = part.bit(np.where(same[rest], 0, pj >> 4), None if decode else (true[rest] == r1))
            told = np.flatnonzero(~same[rest])
            learn(next1, j[told], pj[told], right1[told])
            value = None if decode else true[rest].astype(np.int64)
            found[rest] = r1
            rest_of = np.flatnonzero(~right1)
            lanes.put(rest, part)
            rest = rest[rest_of]
        if len(rest):
            part = lanes.some(rest)
            value = None if decode else true[rest].astype(np.int64)
            # Number of bits of id + 1, less one; 15 stands for all from there on.
            if not decode:
                bits = np.frexp(value + 1.0)[1].astype(np.int64) - 1
                size = np.minimum(bits, 15)
            row = rest * 16 + previous_size[rest]
            rows = size_rows[row]
            size = symbol(part, rows, None if decode else size)
            size_rows[row] = rows + ((TARGETS[size] - rows) >> 5)
            part.shift()
            if decode:
                bits = size
            large = np.flatnonzero(size == 15)
            if len(large):  # the number of further bits comes plain
                sub = part.some(large)
                more = sub.plain(np.full(len(large), 3), None if decode else bits[large] - 15)
                sub.shift()
                part.put(large, sub)
                bits = bits.copy()
                bits[large] = 15 + more
            left = np.maximum(bits - 4, 0)
            below = None if decode else value + 1 - (1 << bits)
            row = rest * 16 + size
            rows = lead_rows[row]
            shown = symbol(part, rows, None if decode else below >> left)
            lead_rows[row] = rows + ((TARGETS[shown] - rows) >> 5)
            part.shift()
            tail = part.plain(left, None if decode else below & ((1 << left) - 1))
            part.shift()
            lanes.put(rest, part)
            found[rest] = (1 << bits) + (shown << left) + tail - 1
            previous_size[rest] = size
        lanes.shift()
        if decode:
            ids[:m, t] = found
        else:
            found = true.astype(np.int64)
        # A wrong prediction loses confidence, and its place when it has none left.
        for guess, sure, at, g, s in ((guess2, sure2, at2, g2, s2), (guess1, sure1, at1, g1, s1)):
            right = g == found
            sure[at] = np.where(right, np.minimum(s + 1, 15), s >> 1)
            guess[at] = np.where(right | (s > 1), g, found)
        before, previous = previous, found
    lanes.finish(lane[:done])
    words[:done] = lanes.at + 2
    return ids, words


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of a sequence of ids below 2**20."""
    if not len(ids):
        return []
    size = int(np.clip(-(-len(ids) // LANES), MIN_BLOCK_IDS, BLOCK_IDS))
    lengths = np.full(-(-len(ids) // size), size)
    lengths[-1] = len(ids) - size * (len(lengths) - 1)
    padded = np.zeros(len(lengths) * size, np.int32)
    padded[: len(ids)] = ids
    grid = padded.reshape(-1, size)
    out = []
    for at in range(0, len(lengths), LANES):
        part, sizes = grid[at : at + LANES], lengths[at : at + LANES]
        stream = np.zeros((len(sizes), size + 8), np.uint32)
        _, words = code_ids(sizes, part, stream)
        for row, n, used, coded in zip(part, sizes, words, stream, strict=True):
            plain = row[:n].astype("<u4").tobytes()
            mode, payload = (1, coded[:used].astype("<u4").tobytes()) if used < n else (0, plain)
            out.append(struct.pack(HEADER, b"TMX1", mode, n, zlib.crc32(plain), len(payload)) + payload)
    return out


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The ids of a sequence of blocks; refuses a block that is damaged."""
    heads = [struct.unpack_from(HEADER, b) for b in blocks]
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(blocks)
    coded = []
    for i, (magic, mode, n, _, size) in enumerate(heads):
        if magic != b"TMX1" or mode > 1 or len(blocks[i]) != struct.calcsize(HEADER) + size:
            raise ValueError("not a block of token ids")
        if mode:
            coded.append(i)
        else:
            found[i] = np.frombuffer(blocks[i], "<u4", n, struct.calcsize(HEADER)).astype(np.int64)
    coded.sort(key=lambda i: -heads[i][2])
    for at in range(0, len(coded), LANES):
        some = coded[at : at + LANES]
        stream = np.zeros((len(some), max(heads[i][4] for i in some) // 4 + 8), np.uint32)
        for row, i in zip(stream, some, strict=True):
            row[: heads[i][4] // 4] = np.frombuffer(blocks[i], "<u4", -1, struct.calcsize(HEADER))
        lengths = np.array([heads[i][2] for i in some])
        ids, _ = code_ids(lengths, None, stream)
        for row, i in zip(ids, some, strict=True):
            found[i] = row[: heads[i][2]]
    for i, ids in enumerate(found):
        if zlib.crc32(ids.astype("<u4").tobytes()) != heads[i][3]:
            raise ValueError("a block of token ids has a wrong checksum")
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class WordTokenizer:
    """Ids of whole texts, word by word: the tokenizer drops white space, so no token spans it.

    Each different word of a piece is looked up once. The first words that a Python worker meets, up to a number, are
    kept for its later pieces and tasks; most of a text's words are among them.
    """

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_str(definition)
        self.end_id = end_id
        kept = vars(tokenizers).setdefault("_tidemark_words", {})  # lives as long as the worker process
        self.known: dict[str, list[int]] = kept.setdefault(zlib.crc32(definition.encode()), {})

    def ids_of(self, words: list[str]) -> list[list[int]]:
        known = self.known
        new = [w for w in words if w not in known]
        fresh = {}
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                fresh[word] = found.ids
        if len(known) < CACHED_WORDS:
            known.update(fresh)
        return [known[w] if w in known else fresh[w] for w in words]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text closed by the end id, and how many each text has."""
        raw, _ = text_buffers(texts)
        words = split_words(texts)
        words = Words(raw, words.start, words.end, words.first)
        _, first, place = np.unique(span_hashes(raw, words.start, words.end), return_index=True, return_inverse=True)
        lists = [*self.ids_of(word_text(words, first).to_pylist()), [self.end_id]]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for ids in lists for i in ids), np.int64, int(sizes.sum()))
        begins = np.cumsum(sizes) - sizes
        sequence = np.insert(place, words.first[1:], len(lists) - 1)
        length = sizes[sequence]
        upto = np.cumsum(length)
        ids = flat[np.repeat(begins[sequence] - (upto - length), length) + np.arange(int(upto[-1]) if len(upto) else 0)]
        last = words.first[1:] + np.arange(len(words.first) - 1)  # places of the end ids in the sequence
        return ids, np.diff(np.append(0, upto[last]))


CHUNKS = "run int, chunk int, before bigint, n_ids bigint, doc_ids binary, named binary, lengths binary, blocks array<binary>"


def encode_batches(definition: str, end_id: int):
    """One run: the documents of a task, in the order they come, as chunks."""

    def chunk_row(number: int, before: int, held: list[tuple]) -> pa.RecordBatch:
        ids = np.concatenate([h[0] for h in held])
        lengths = np.concatenate([h[1] for h in held])
        docs = pa.concat_arrays([h[2] for h in held])
        names = np.array(docs.is_valid(), bool)
        row = {
            "run": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "chunk": pa.array([number], pa.int32()),
            "before": pa.array([before], pa.int64()),
            "n_ids": pa.array([len(ids)], pa.int64()),
            "doc_ids": pa.array([np.asarray(docs.fill_null(0)).astype("<i8").tobytes()], pa.binary()),
            "named": pa.array([np.packbits(names).tobytes()], pa.binary()),
            "lengths": pa.array([lengths.astype("<i8").tobytes()], pa.binary()),
            "blocks": pa.array([encode_blocks(ids)], pa.list_(pa.binary())),
        }
        return pa.RecordBatch.from_arrays(list(row.values()), list(row))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(definition, end_id)
        held, size, number, before = [], 0, 0, 0
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, lengths = tokenizer.encode(part.column("text"))
                held.append((ids.astype(np.int32), lengths, part.column("doc_id")))
                size += len(ids)
                if size >= CHUNK_IDS:
                    yield chunk_row(number, before, held)
                    held, before, number, size = [], before + size, number + 1, 0
        if held:
            yield chunk_row(number, before, held)

    return rows


DECODED = "run int, before bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"


def decode_batches(with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_blocks(row["blocks"])
                lengths = np.frombuffer(row["lengths"], "<i8")
                names = np.unpackbits(np.frombuffer(row["named"], np.uint8), count=len(lengths)).astype(bool)
                ends = np.cumsum(lengths)
                plain = ids.astype("<u4")
                crcs = [zlib.crc32(plain[a:b].tobytes()) for a, b in zip(ends - lengths, ends, strict=True)]
                lists = [plain[a:b] for a, b in zip(ends - lengths, ends, strict=True)] if with_ids else [[]] * len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), row["run"], np.int32)),
                        pa.array(row["before"] + ends - lengths),
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=~names),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                        pa.array(lists, pa.list_(pa.int32())),
                    ],
                    ["run", "before", "doc_id", "n_tokens", "ids_crc32", "ids"],
                )

    return rows


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encodes whole texts into chunks of blocks and writes them to shared scratch; returns the written table."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = chosen.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(encode_batches(definition, end_id), CHUNKS))


def read_ids(chunks: DataFrame, with_ids: bool = True) -> DataFrame:
    """Decodes written chunks: doc_id, start, n_tokens, ids_crc32 and, if wanted, the ids."""
    totals = chunks.groupBy("run").agg(F.sum("n_ids").alias("all"))  # one row per run
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("run", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("offset"))
    decoded = chunks.mapInArrow(decode_batches(with_ids), DECODED)
    placed = decoded.join(F.broadcast(offsets), "run").withColumn("start", F.col("offset") + F.col("before"))
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    chunks = write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(chunks, with_ids=False)
