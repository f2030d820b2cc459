"""N-gram Jaccard join by vertical partitioning: groups of documents whose word n-gram sets are alike.

1. Order. A count-min row of fixed size counts the n-grams of all documents. The global order of n-grams is (count of its
   slot, hash): rare ones first, and the same in every task. The order is cut into fragments of like size.
2. Classes. Documents with equal sets are one class; the class meets the others once, not once per copy.
3. Candidates. Two sets that reach the threshold share an n-gram among the first n - ceil(t*n) + 1 of each in the global
   order. Only these prefixes are shuffled. N-grams that stand in the prefix of one document only drop out by an
   aggregate; what is left links each class to the smallest one of its n-gram (a star, not all pairs), if lengths and
   prefix positions allow the threshold.
4. Overlaps. The sets of the candidates are cut along the fragments. The overlap of a pair is counted fragment by
   fragment, each on its own, and the partial overlaps are summed per pair. The comparison is in whole numbers.
5. Components of the verified links. A pair of one n-gram that is not yet in one component is then a candidate too, under
   the same condition, and verified in the same way. So no link between different components is missed, and pairs inside
   a component are never spelled out.

Filters of fixed size keep n-grams that only one document has, and sets of documents that no candidate needs, out of the
shuffles; what they let through by chance falls out in exact joins.

Defined results: a null or empty text, or one without words, has an empty set, links with nothing and is its own
component. A text with fewer words than n has one element, its whole sequence. Repeated rows come out as often as they
went in. A null doc_id takes part; if a whole component has none, its id is null. A doc_id that stands on different texts
is compared with each of them. The component is the smallest doc_id. An empty table gives no rows. Of the input only the
id and the text are read, so other columns cannot clash. N-grams are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.counts import COUNTED, bit_filter, block_batch, filled, has_bit, summed_tables
from tidemark.llm.graph import components
from tidemark.llm.tables import table
from tidemark.llm.textbytes import pieces, shingle_sets
from tidemark.session import materialize

SIZE = 5  # words of an n-gram
PERCENT = 80  # least Jaccard similarity
SLOT_BITS = 20  # of the table of counts: 2**20 slots
FRAGMENTS = 8
FILTER_BITS = 26  # of the filters for shared n-grams and for needed documents: 8 MB each


def slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def count_grams(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = list(shingle_sets(part.column("text"), size))
                counts += np.bincount(slots(np.concatenate(sets)), minlength=1 << SLOT_BITS)
        yield block_batch({"grams": counts})

    return count


def digest(grams: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), "<i8").tolist())


def list_array(values: list[np.ndarray]) -> pa.Array:
    bounds = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=bounds[1:])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.astype(np.uint64).view(np.int64)))


SETS = "doc_id bigint, n int, d1 bigint, d2 bigint, prefix array<bigint>"


def prefix_rows(counts: Broadcast, size: int, percent: int):
    """Per document: size and digest of its set, and its prefix in the global order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = counts.value
        for batch in batches:
            for part in pieces(batch, "text"):
                n, d1, d2, prefixes = [], [], [], []
                for grams in shingle_sets(part.column("text"), size):
                    first, second = digest(grams)
                    n.append(len(grams))
                    d1.append(first)
                    d2.append(second)
                    ranked = np.lexsort((grams, order[slots(grams)]))
                    prefixes.append(grams[ranked[: prefix_length(len(grams), percent)]] if len(grams) else grams)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int32()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), list_array(prefixes)],
                    ["doc_id", "n", "d1", "d2", "prefix"],
                )

    return rows


POSTINGS = "row bigint, n int, pos int, gram bigint"


def shared_postings(shared: Broadcast):
    """Of the prefixes (row, n, prefix) the n-grams that pass the filter, each with its position."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column("prefix")
            bounds = prefixes.offsets.to_numpy()
            grams = prefixes.values.to_numpy()[bounds[0] : bounds[-1]]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            kept = np.flatnonzero(has_bit(shared.value, grams, FILTER_BITS))
            of = owner[kept]
            arrays = [
                pa.array(batch.column("row").to_numpy()[of]),
                pa.array(batch.column("n").to_numpy()[of]),
                pa.array((kept - (bounds[:-1] - bounds[0])[of]).astype(np.int32)),
                pa.array(grams[kept]),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "n", "pos", "gram"])

    return rows


FRAGMENT_ROWS = "d1 bigint, d2 bigint, fragment int, grams array<bigint>"


def fragment_rows(fragment_of: Broadcast, needed: Broadcast, size: int):
    """Per document that may be needed (by its mark), and fragment of the order: the n-grams of its set there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fragments, bits = fragment_of.value, needed.value
        for batch in batches:
            wanted = batch.filter(pa.array(has_bit(bits, batch.column("mark").to_numpy(), FILTER_BITS)))
            for part in pieces(wanted, "text"):
                out: list[tuple[int, int, int]] = []
                cut: list[np.ndarray] = []
                for grams in shingle_sets(part.column("text"), size):
                    d1, d2 = digest(grams)
                    if not len(grams):
                        continue
                    own = fragments[slots(grams)]
                    for f in np.unique(own).tolist():
                        out.append((d1, d2, f))
                        cut.append(grams[own == f])
                if out:
                    a, b, c = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int32()), list_array(cut)],
                        ["d1", "d2", "fragment", "grams"],
                    )

    return rows


class Verifier:
    """Verifies candidate pairs (a, b, na, nb) of classes by partial overlaps per fragment."""

    def __init__(self, texts: DataFrame, classes: DataFrame, fragment_of: Broadcast, size: int, percent: int):
        self.texts = texts.select("text", self.mark("doc_id"))
        self.classes, self.fragment_of, self.size, self.percent = classes, fragment_of, size, percent

    @staticmethod
    def mark(doc: str):
        return F.xxhash64(F.coalesce(F.col(doc), F.lit(0).cast("bigint"))).alias("mark")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that reach the threshold. `pairs` is a written table."""
        if pairs.isEmpty():
            return pairs.select("a", "b")
        spark = self.texts.sparkSession
        ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
        marks = ids.join(self.classes, "cid").select(self.mark("first_doc"))
        needed = spark.sparkContext.broadcast(bit_filter(marks, "mark", FILTER_BITS))
        cut = self.texts.mapInArrow(fragment_rows(self.fragment_of, needed, self.size), FRAGMENT_ROWS)

        def sets(side: str) -> DataFrame:
            return cut.withColumnsRenamed({"d1": f"{side}1", "d2": f"{side}2", "grams": f"grams_{side}"})

        def digests(side: str) -> DataFrame:
            return self.classes.select(F.col("cid").alias(side), F.col("d1").alias(f"{side}1"), F.col("d2").alias(f"{side}2"))

        cells = pairs.join(digests("a"), "a").join(digests("b"), "b")
        cells = cells.withColumn("fragment", F.explode(F.array(*map(F.lit, range(FRAGMENTS)))))
        partial = cells.join(sets("a"), ["a1", "a2", "fragment"]).join(sets("b"), ["b1", "b2", "fragment"])
        partial = partial.select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("grams_a", "grams_b")).alias("part"))
        # Where the same set was read from several rows, every one gives the same count.
        partial = partial.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("part").alias("part"))
        overlap = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("both"))
        union = F.col("na") + F.col("nb") - F.col("both")
        found = materialize(overlap.filter(F.col("both") * 100 >= union * self.percent).select("a", "b"))
        needed.destroy()
        return found


def reachable(na: Column, nb: Column, pos_a: Column, pos_b: Column, percent: int) -> Column:
    """May two sets of these sizes reach the threshold, if the n-gram at these positions is their first common one?

    For a linked pair this holds at the first common n-gram of both sets, which stands in both prefixes: all common ones
    are at it or behind it, and must be percent/(100 + percent) of both sizes together.
    """
    most = 1 + F.least(na - 1 - pos_a, nb - 1 - pos_b)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (most * (100 + percent) >= (na + nb) * percent)


def similar_groups(docs: DataFrame, text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    blocks = summed_tables(texts.mapInArrow(count_grams(size), COUNTED))
    counts = filled(blocks.get("grams", {}), 1 << SLOT_BITS)
    ranked = np.argsort(counts, kind="stable")
    fragment_of = np.empty(len(counts), np.int8)
    mass = np.cumsum(counts[ranked])
    fragment_of[ranked] = np.minimum(mass * FRAGMENTS // max(int(mass[-1]), 1), FRAGMENTS - 1)
    order = spark.sparkContext.broadcast(np.minimum(counts, 2**31 - 1).astype(np.int32))

    sets = texts.mapInArrow(prefix_rows(order, size, percent), SETS)
    sets = materialize(sets.withColumn("row", F.monotonically_increasing_id()))
    order.destroy()
    filled_sets = sets.filter("n > 0")
    classes = materialize(
        filled_sets.groupBy("d1", "d2").agg(
            F.min("row").alias("cid"), F.min("doc_id").alias("first_doc"), F.first("n").alias("n")
        )
    )
    class_of = materialize(
        filled_sets.select("doc_id", "row", "n", "d1", "d2").join(classes.select("cid", "d1", "d2"), ["d1", "d2"]).select("row", "cid")
    )
    # A prefix has an n-gram once, so counting rows tells whether several documents have it.
    postings = filled_sets.select(F.explode("prefix").alias("gram"))
    several = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("documents"))
    shared = materialize(several.filter("documents > 1").select("gram"))
    passing = spark.sparkContext.broadcast(bit_filter(shared, "gram", FILTER_BITS))
    met = filled_sets.select("row", "n", "prefix").mapInArrow(shared_postings(passing), POSTINGS)
    met = met.join(shared, "gram").join(class_of, "row")
    met = materialize(met.select("gram", "cid", "n", "pos").distinct())
    passing.destroy()

    centre = met.groupBy("gram").agg(F.min(F.struct("cid", "n", "pos")).alias("centre"))
    star = met.join(centre, "gram").filter(F.col("cid") != F.col("centre.cid"))
    star = star.filter(reachable(F.col("centre.n"), F.col("n"), F.col("centre.pos"), F.col("pos"), percent))
    star = star.select(
        F.col("centre.cid").alias("a"), F.col("cid").alias("b"), F.col("centre.n").alias("na"), F.col("n").alias("nb")
    )
    star = materialize(star.distinct())
    fragments = spark.sparkContext.broadcast(fragment_of)
    verifier = Verifier(texts, classes, fragments, size, percent)
    links = verifier.links(star)

    labels = components(links)
    marked = met.join(labels, F.col("cid") == F.col("node"), "left").select(
        "gram", "cid", "n", "pos", F.coalesce("component", "cid").alias("component")
    )
    apart = marked.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    left = materialize(marked.join(apart.select("gram"), "gram"))
    x, y = left.alias("x"), left.alias("y")
    na, nb = F.col("x.n"), F.col("y.n")
    other = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.cid") < F.col("y.cid"))
    other = other & (F.col("x.component") != F.col("y.component")) & reachable(na, nb, F.col("x.pos"), F.col("y.pos"), percent)
    rest = x.join(y, other).select(
        F.col("x.cid").alias("a"), F.col("y.cid").alias("b"), na.alias("na"), nb.alias("nb")
    )
    rest = materialize(rest.distinct().join(star.select("a", "b"), ["a", "b"], "left_anti"))
    more = verifier.links(rest)
    fragments.destroy()
    # Without a further link the components stand as they are.
    final = labels if more.isEmpty() else components(links.union(more))

    named = classes.join(final, F.col("cid") == F.col("node"), "left").select(
        "cid", "first_doc", F.coalesce("component", "cid").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    by_class = named.join(smallest, "component").select("cid", "component_id")
    by_row = class_of.join(by_class, "cid").select("row", "component_id")
    result = sets.select("doc_id", "row", F.col("n").cast("bigint").alias("n_shingles")).join(by_row, "row", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return result.select("doc_id", "n_shingles", own.alias("component_id"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words
), classes AS (
    SELECT min(doc_id) AS c, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), member AS (
    SELECT sets.doc_id, len(sets.s) AS n, classes.c FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s
), grams AS (
    SELECT c, len(s) AS n, unnest(s) AS g FROM classes
), met AS (
    SELECT x.c AS a, y.c AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS o
    FROM grams x JOIN grams y ON x.g = y.g AND x.c < y.c AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
    GROUP BY x.c, y.c
), links AS (
    SELECT a, b FROM met WHERE 100 * o >= 80 * (na + nb - o) UNION SELECT b, a FROM met WHERE 100 * o >= 80 * (na + nb - o)
), reach(c, r) AS (
    SELECT c, c FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.r = links.a
), component AS (
    SELECT c, min(r) AS component_id FROM reach GROUP BY c
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM member LEFT JOIN component ON member.c = component.c
"""
