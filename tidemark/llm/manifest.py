"""Merkle manifest of a dataset: one hash for all rows, and a proof per row against which a changed row shows.

A leaf is the SHA-256 of a row's fields. Leaves of a source, by doc_id, are hashed in runs of 16, the hashes again in runs
of 16, until one is left, the subroot; the subroots of all sources go up the same way to the root. The levels are built by
Spark, each from the one below, and stored: the runs of leaves as one row per run, and every node above as a row with its
parent's id and hash and the hashes beside it. A recursive query then climbs from the leaves: each step joins a
climber with its node, appends the siblings to its proof and folds the leaf's present hash with them. The leaves of one
run share their siblings from the first node on, so they climb in one row, which holds the hash each has reached. Climbers
carry digests as bytes, half as long as the hex text that is hashed.

High nodes are met by very many climbers, so climbers are dealt into LANES lanes and a node is stored once for each lane
below it: in one row above a single run, in LANES rows at most. No row holds more than 16 nodes and a proof, whose length is
logarithmic. Leaves are numbered by range partitions, so a source with a third of all rows is spread.

Defined results: a null field is `-`. Null doc_ids come first and are not tampered with. Rows with one doc_id are ordered
by their hash; rows that are alike count as often as they occur. A null source is a source of its own, before the others. A
lone leaf is its subroot, a lone source's subroot is the root, and their proofs are empty. Long texts are hashed where
they are read. An empty table has no rows and no root. Further columns are not hashed and not returned.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.sqltext import crc32
from tidemark.llm.tables import table
from tidemark.operators.keys import number_rows
from tidemark.session import materialize

WIDTH = 16
LANES = 256
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
NODES = "id string, lane int, parent string, parent_hash binary, before binary, after binary"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Manifest(NamedTuple):
    """Written tables: runs of leaves, nodes above them; and the id of the root."""

    runs: DataFrame
    nodes: DataFrame
    root: str


def leaf_hash(fields: dict[str, Column]) -> Column:
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(value) for value in fields.values()]), 256)


def run_hash(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def beside(hashes: Column, at: Column) -> tuple[Column, Column]:
    """The hashes of a run before and after its node number `at` (from 0), each joined to one text."""
    before = F.array_join(F.slice(hashes, F.lit(1), at), "")
    return before, F.array_join(F.slice(hashes, at + 2, F.lit(WIDTH)), "")


def lane(tree: Column, at: Column) -> Column:
    return ((tree + at) % LANES).cast("int")


def level_above(nodes: DataFrame, level: int, last: Column) -> DataFrame:
    """The parents of some trees' nodes, written; `last` is the id of a tree's only node."""
    kids = F.sort_array(F.collect_list(F.struct("at", "id", "hash", "lanes")))
    up = nodes.groupBy("tree", F.floor(F.col("at") / WIDTH).alias("at")).agg(kids.alias("kids"), F.max("n").alias("below"))
    n = F.ceil(F.col("below") / WIDTH)
    return materialize(
        up.select(
            "tree",
            "at",
            n.alias("n"),
            F.when(n == 1, last).otherwise(F.concat_ws(".", "tree", F.lit(level), "at")).alias("id"),
            run_hash(F.col("kids.hash")).alias("hash"),
            F.array_distinct(F.flatten("kids.lanes")).alias("lanes"),
            "kids",
        )
    )


def node_rows(parents: DataFrame) -> DataFrame:
    """The rows of NODES for the children in a level."""
    kid = parents.select("id", "hash", "kids", F.posexplode("kids").alias("place", "kid"))
    before, after = beside(F.col("kids.hash"), F.col("place"))
    return kid.select(
        F.col("kid.id").alias("id"),
        F.explode("kid.lanes").alias("lane"),
        F.col("id").alias("parent"),
        F.unhex("hash").alias("parent_hash"),
        F.unhex(before).alias("before"),
        F.unhex(after).alias("after"),
    )


def build_manifest(leaves: DataFrame, group: str, order: str) -> Manifest:
    """Trees over the leaves of each group, and one over the groups. `leaves` has group, order, leaf and further columns.

    A run has tree, at, n (nodes on its level), id and hash of its node, and its leaves in order.
    """
    spark = leaves.sparkSession
    numbered = number_rows(leaves, [order, "leaf"], [group], "number")
    numbered = materialize(numbered)
    sizes = numbered.groupBy(group).agg(F.max("number").alias("n"))
    trees = materialize(number_rows(sizes, [group], name="tree"))
    groups, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    named = trees.select(F.col(group).alias("__group"), (F.col("tree") - 1).alias("__tree"), F.col("n").alias("__n"))
    placed = numbered.join(named, F.col(group).eqNullSafe(F.col("__group")))
    columns = [c for c in leaves.columns if c != group]
    run = placed.groupBy(
        F.col("__tree").alias("tree"), F.floor((F.col("number") - 1) / WIDTH).alias("at"), F.col("__n").alias("size")
    ).agg(F.sort_array(F.collect_list(F.struct("number", *columns))).alias("leaves"))
    n = F.ceil(F.col("size") / WIDTH)
    subroot = F.concat(F.lit("s"), "tree")
    runs = materialize(
        run.select(
            "tree",
            "at",
            n.alias("n"),
            F.when(n == 1, subroot).otherwise(F.concat_ws(".", "tree", F.lit(1), "at")).alias("id"),
            F.when(F.col("size") == 1, F.col("leaves")[0]["leaf"]).otherwise(run_hash(F.col("leaves.leaf"))).alias("hash"),
            F.col("leaves"),
        )
    )
    nodes = runs.select("tree", "at", "n", "id", "hash", F.array(lane(F.col("tree"), F.col("at"))).alias("lanes"))
    rows = spark.createDataFrame([], NODES)
    subroots, level, most = nodes.filter("n = 1"), 1, -(-most // WIDTH)
    while most > 1:
        level, most = level + 1, -(-most // WIDTH)
        parents = level_above(nodes.filter("n > 1"), level, subroot)
        rows, nodes = rows.union(node_rows(parents)), parents.drop("kids")
        subroots = subroots.union(nodes.filter("n = 1"))
    nodes = subroots.select(F.lit("top").alias("tree"), F.col("tree").alias("at"), F.lit(groups).alias("n"), "id", "hash", "lanes")
    width = groups
    while width > 1:
        level, width = level + 1, -(-width // WIDTH)
        parents = level_above(nodes, level, F.lit("root"))
        rows, nodes = rows.union(node_rows(parents)), parents.drop("kids")
    return Manifest(runs, materialize(rows), "root" if groups > 1 else "s0")


CLIMB = """
WITH RECURSIVE climb(tree, at, lane, id, folded, proof, subroot, root) AS (
  SELECT tree, at, lane, id, folded, X'', CASE WHEN id LIKE 's%' THEN unhex(hash) END, unhex(hash)
  FROM {starts}
  UNION ALL
  SELECT c.tree, c.at, c.lane, n.parent,
    transform(c.folded, f -> unhex(sha2(lower(hex(concat(n.before, f, n.after))), 256))), concat(c.proof, n.before, n.after),
    CASE WHEN n.parent LIKE 's%' THEN n.parent_hash ELSE c.subroot END, n.parent_hash
  FROM climb c JOIN {nodes} n ON n.id = c.id AND n.lane = c.lane)
SELECT tree, at, folded, proof, lower(hex(subroot)) AS subroot, lower(hex(root)) AS root FROM climb WHERE id = {top}
"""


def prove(manifest: Manifest, present: str) -> DataFrame:
    """Per leaf: its columns, subroot, root, proof (siblings from the leaf up) and folded_root.

    `present` is the column of the leaf's hash as it is now, null if it is unchanged.
    """
    spark = manifest.runs.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the climb has a row per run and level
    hashes = F.col("leaves.leaf")

    def fold(leaf: Column, at: Column) -> Column:
        before, after = beside(hashes, at)
        now = F.coalesce(leaf[present], leaf["leaf"])
        return F.when((F.size(hashes) == 1) & (F.col("id").startswith("s")), now).otherwise(F.sha2(F.concat(before, now, after), 256))

    folded = F.transform("leaves", lambda leaf, at: F.unhex(fold(leaf, at)))
    starts = manifest.runs.select("tree", "at", lane(F.col("tree"), F.col("at")).alias("lane"), "id", "hash", folded.alias("folded"))
    climbed = materialize(spark.sql(CLIMB, starts=starts, nodes=manifest.nodes, top=manifest.root))
    met = manifest.runs.select("tree", "at", "leaves").join(climbed, ["tree", "at"])
    each = met.select("*", F.posexplode("leaves").alias("place", "own"))
    before, after = beside(hashes, F.col("place"))
    return each.select(
        "own.*",
        "subroot",
        "root",
        F.concat(before, after, F.lower(F.hex("proof"))).alias("proof"),
        F.lower(F.hex(F.col("folded")[F.col("place")])).alias("folded_root"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {c: F.col(c) for c in FIELDS}
    lowered = {**fields, "text": F.translate("text", LETTERS, LETTERS.lower())}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf_hash(lowered))
    leaves = table(spark, sf_dir, "documents").select("doc_id", "source", leaf_hash(fields).alias("leaf"), tampered.alias("tampered"))
    proofs = prove(build_manifest(leaves, "source", "doc_id"), "tampered")
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({" || ".join(_field(c) for c in FIELDS)}) AS leaf,
    CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN
      sha256({" || ".join(_field(c) for c in FIELDS[:4])} || {_field(f"translate(text, '{LETTERS}', '{LETTERS.lower()}')")}) END AS tampered
  FROM documents),
sources AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves GROUP BY source),
placed AS (
  SELECT l.*, tree, n, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves l JOIN sources s ON s.source IS NOT DISTINCT FROM l.source),
grown(tree, level, pos, n, hash) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM grown WHERE n > 1
  GROUP BY tree, level, pos // 16, n),
tops(tree, level, pos, n, hash) AS (
  SELECT -1::BIGINT, 0, tree, (SELECT count(*) FROM sources), hash FROM grown WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY pos)) FROM tops WHERE n > 1
  GROUP BY tree, level, pos // 16, n),
nodes AS (
  SELECT *, coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT * FROM grown UNION ALL SELECT * FROM tops)
  WINDOW run AS (PARTITION BY tree, level, pos // 16 ORDER BY pos)),
climb(tree, leaf_pos, pos, own, level, proof, folded) AS (
  SELECT tree, pos, pos, tree, 0, '', coalesce(tampered, leaf) FROM placed
  UNION ALL
  SELECT CASE WHEN k.n > 1 THEN k.tree ELSE -1 END, c.leaf_pos, CASE WHEN k.n > 1 THEN c.pos // 16 ELSE k.tree END, c.own,
    CASE WHEN k.n > 1 THEN c.level + 1 ELSE 0 END, c.proof || CASE WHEN k.n > 1 THEN k.before || k.after ELSE '' END,
    CASE WHEN k.n > 1 THEN sha256(k.before || c.folded || k.after) ELSE c.folded END
  FROM climb c JOIN nodes k ON k.tree = c.tree AND k.level = c.level AND k.pos = c.pos
  WHERE k.n > 1 OR k.tree >= 0),
ended AS (
  SELECT c.*, k.hash AS root FROM climb c JOIN nodes k ON k.tree = c.tree AND k.level = c.level AND k.pos = c.pos
  WHERE k.tree = -1 AND k.n = 1)
SELECT doc_id, leaf, g.hash AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed p JOIN ended e ON e.own = p.tree AND e.leaf_pos = p.pos JOIN grown g ON g.tree = p.tree AND g.n = 1
"""
