"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

A text is cut into sections (before a blank line or a line that begins with #), a section into paragraphs (its lines),
a paragraph into clauses (after white space that follows punctuation or a word in e). All cuts are lossless, so the SHA-256 root over
section hashes over paragraph hashes is equal exactly if the texts are. Below each paragraph hang its clauses, each as a
64-bit code: 40 bits of hash and 24 bits of length. The fingerprint is one string:

    root/section;section    section = paragraph.paragraph    paragraph = code,code    code = 16 hex digits

so two fingerprints alone tell equality (the roots), likeness (the share of code points in common clauses) and the
sections and paragraphs that differ. Everything is built-in functions; a tree is built where its row is, and no group of
rows is ever gathered.

Defined results: a null text counts as empty; the empty text has one empty section and likeness 1 to itself. Clauses that
a text repeats count once. A clause of over 2**24 - 1 code points weighs that many. Very long texts are cut like others;
one row is the unit of memory. Repeated rows (same doc_id and text) count as one document when the next one is sought
and all come out. Null ids come last in descending order. A table with one document has itself as the next. An empty
table gives no rows. Further columns are not read by the query; `with_tree` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import table
from tidemark.operators.keys import number_rows
from tidemark.session import materialize

SECTION_START = r"\n(?=[ \t\r]*(?:\n|#))"
# Punctuation, or a word in e: texts without punctuation have clauses too.
CLAUSE_END = r"(?<=[.!?,;:|%$&*#e][ \t])"
LENGTH_BITS = 24


def clause_code(clause: Column) -> Column:
    """64-bit code of a clause: hash above, length in code points below."""
    length = F.least(F.length(clause), F.lit((1 << LENGTH_BITS) - 1)).cast("bigint")
    return F.shiftleft(F.xxhash64(clause), LENGTH_BITS).bitwiseOR(length)


def tree(text: Column) -> Column:
    """array<section array<paragraph struct(hash, codes)>> of a text."""

    def paragraph(line: Column) -> Column:
        codes = F.transform(F.split(line, CLAUSE_END), clause_code)
        return F.struct(F.sha2(line, 256).alias("hash"), codes.alias("codes"))

    def section(lines: Column) -> Column:
        return F.transform(F.split(lines, "\n"), paragraph)

    return F.transform(F.split(F.coalesce(text, F.lit("")), SECTION_START), section)


def root(nodes: Column) -> Column:
    """SHA-256 over the section hashes, each over its paragraph hashes."""
    sections = F.transform(nodes, lambda s: F.sha2(F.array_join(F.transform(s, lambda p: p["hash"]), ""), 256))
    return F.sha2(F.array_join(sections, ""), 256)


def codes(nodes: Column) -> Column:
    """Distinct clause codes of the whole tree, without the empty clause."""
    every = F.flatten(F.transform(F.flatten(nodes), lambda p: p["codes"]))
    return F.array_distinct(F.filter(every, lambda c: weight(c) > 0))


def weight(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << LENGTH_BITS) - 1))


def total_weight(clauses: Column) -> Column:
    return F.aggregate(clauses, F.lit(0).cast("bigint"), lambda total, c: total + weight(c))


def fingerprint_text(root_hash: Column, nodes: Column) -> Column:
    def hexed(p: Column) -> Column:
        return F.array_join(F.transform(p["codes"], lambda c: F.lpad(F.hex(c), 16, "0")), ",")

    sections = F.transform(nodes, lambda s: F.array_join(F.transform(s, hexed), "."))
    return F.concat(root_hash, F.lit("/"), F.array_join(sections, ";"))


def with_tree(docs: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds <prefix>fingerprint, and <prefix>root and <prefix>codes for comparing."""
    nodes, top, plain = f"__{prefix}nodes", f"{prefix}root", f"{prefix}codes"
    grown = docs.withColumn(nodes, tree(F.col(text)))
    summed = grown.withColumns({top: root(F.col(nodes)), plain: codes(F.col(nodes))})
    return summed.withColumn(f"{prefix}fingerprint", fingerprint_text(F.col(top), F.col(nodes))).drop(nodes)


def likeness(root_a: Column, codes_a: Column, root_b: Column, codes_b: Column) -> Column:
    """Share of code points that stand in clauses which both have: 1 for equal roots, 0 for nothing in common.

    Texts that differ only in the order or number of their clauses have all of them in common; so that only equal roots
    give 1, the share of others stays below it by at least one part in their size.
    """
    both, size = total_weight(F.array_intersect(codes_a, codes_b)) * 2.0, total_weight(codes_a) + total_weight(codes_b)
    share = F.coalesce(both / F.nullif(size, F.lit(0)), F.lit(0.0))
    return F.when(root_a == root_b, 1.0).otherwise(F.least(share, 1.0 - 1.0 / (size + 1)))


def stored_codes(fingerprint: Column) -> Column:
    """Paragraphs of a stored fingerprint by section: array<array<string>>, each paragraph its codes in hex."""
    body = F.substring_index(fingerprint, "/", -1)
    return F.transform(F.split(body, ";"), lambda s: F.split(s, r"\."))


def differing(fingerprint_a: Column, fingerprint_b: Column) -> Column:
    """Where two stored fingerprints differ: array<struct(section, paragraph)> of the first, from 0.

    Sections that stand as a whole in the other document are not looked into; in the others, the paragraphs that the
    other document has nowhere are listed. Empty for equal texts.
    """
    a, b = stored_codes(fingerprint_a), stored_codes(fingerprint_b)
    elsewhere = F.flatten(b)

    def changed(section: Column, at: Column) -> Column:
        marked = F.transform(
            section,
            lambda p, i: F.when(
                ~F.array_contains(elsewhere, p), F.struct(at.alias("section"), i.alias("paragraph"))
            ),
        )
        return F.when(F.array_contains(b, section), F.filter(marked, lambda _: F.lit(False))).otherwise(
            F.filter(marked, lambda m: m.isNotNull())
        )

    return F.flatten(F.transform(a, changed))


def next_documents(keys: DataFrame) -> DataFrame:
    """(doc_id, text hash) of every distinct row with those of the next one in descending doc_id, the last with the first.

    Only ids and hashes are ordered, in a distributed way; texts stay where they are. next_copies counts the rows that
    are the next one.
    """
    distinct = keys.groupBy("doc_id", "hash").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    # Ascending numbers: nulls first there is nulls last in descending order.
    numbered = materialize(number_rows(distinct, ["doc_id", "hash"], name="n"))
    last = numbered.agg(F.max("n")).first()[0] or 0
    following = numbered.select(
        F.col("doc_id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("copies").alias("next_copies"), F.col("n").alias("m")
    )
    placed = numbered.withColumn("m", F.when(F.col("n") > 1, F.col("n") - 1).otherwise(F.lit(last)))
    return placed.join(following, "m").select("doc_id", "hash", "n_chars", "next_id", "next_hash", "next_copies")


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and the likeness to the edited text and the next document.

    The text of each document is shuffled once by its own key and serves both as itself and as the next one of another.
    """
    whole = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", whole.alias("text"), F.xxhash64(whole).alias("hash"))
    size = F.length("text").cast("bigint")
    pairs = materialize(next_documents(docs.select("doc_id", F.xxhash64(whole).alias("hash"), F.length(whole).cast("bigint").alias("n_chars"))))
    wanted = pairs.select(
        F.col("doc_id").alias("for_id"),
        F.col("hash").alias("for_hash"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("cut"),
        "next_id",
        "next_hash",
        "next_copies",
    )
    is_next = F.col("doc_id").eqNullSafe(F.col("next_id")) & (F.col("hash") == F.col("next_hash"))

    def serve(following: DataFrame) -> DataFrame:
        return with_tree(following, "text", "next_").select(
            "for_id", "for_hash", F.expr("left(text, cut)").alias("head"), "next_root", "next_codes"
        )

    # Rows that repeat are one document: only for those is one row chosen, by an aggregate with map-side combining.
    repeated = own.join(wanted.filter("next_copies > 1"), is_next).groupBy("for_id", "for_hash", "cut").agg(F.first("text").alias("text"))
    served = serve(own.join(wanted.filter("next_copies = 1"), is_next)).union(serve(repeated))
    is_own = F.col("doc_id").eqNullSafe(F.col("for_id")) & (F.col("hash") == F.col("for_hash"))
    joined = own.join(served, is_own).withColumn("n_chars", size)
    kept = F.expr("left(text, CAST(n_chars - floor(n_chars / 3) AS INT))")
    edited = joined.withColumn("edited", F.concat(kept, "head")).drop("head")
    both = with_tree(with_tree(edited, "text", ""), "edited", "edited_")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("root"), F.col("codes"), F.col("edited_root"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("root"), F.col("codes"), F.col("next_root"), F.col("next_codes")).alias("near_next"),
    )


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
