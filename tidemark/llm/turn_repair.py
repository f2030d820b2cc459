"""Conversation structure repair: the cheapest edits that make the turns of a conversation alternate.

Roles must spell `(s?(ua)+)?` by their initials: an optional system turn, then pairs of user and assistant. Keep costs 0,
a new role (user or assistant) 1, Delete 2, Insert of an empty turn 5, and a truncated turn that stays 5 more. Blank and
repeated turns must go. There is one target string per length, so turns are aligned with the target of each feasible
length by the table of Wagner and Fischer. The targets of all lengths end alike: a cell is (turns read, characters of
the target left), and one table serves every length. It is filled only inside Ukkonen's band: a plain repair gives an
incumbent cost, and cells whose surplus of turns or characters alone costs more are left out. Every length that reaches
the least cost is traced back to its audit, the string of edits (D, I, K, R), and the ASCII-least audit wins.

In Spark, a conversation's rows meet in one sorted stream: first the states of its turns, one character each, then its
texts, which pass through. So a task holds a few bytes per turn of one conversation and never its texts; the digest of a
conversation is one running SHA-256, which cannot be put together from parts. Conversations with the same states share
one alignment.

Defined results: a null role or text is one space. A null conv_id is a conversation of its own. Null turns come first;
rows with one turn number are taken by role and text, so that repeated rows stand together. A role with another initial
has to be replaced or deleted; an empty role has no initial and is illegal beside any turn. Long texts only pass by. The
alignment of n turns takes time of n times the width of the band, and memory of the root of n times that width. Empty
tables give no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.sqltext import crc32
from tidemark.llm.tables import table

RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = "\t\n\x0b\x0c\r "
# The state of a turn is one character, at 4 * fault + initial (s, u, a, any other).
STATES = "SUAXsuax01234567"
FAULTS = ["truncated", None, "blank", "duplicate"]
CUT, FINE, BLANK, DUPLICATE = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FAR = 1 << 40  # more than any repair costs
# Alignments kept in a worker for conversations with the same states.
KEPT_ALIGNMENTS = 20_000
EDITS = "place bigint, edit string, turn bigint, role string, text string, fault string, was string"


def plain_cost(fault: np.ndarray, initial: np.ndarray) -> int:
    """Cost of the better of three repairs: all turns go; those off the alternation go; those off it get a new role."""
    usable = (fault == FINE) | (fault == CUT)
    gone = DELETE * int(np.count_nonzero(~usable))
    roles, cut = initial[usable].tolist(), (fault[usable] == CUT).tolist()
    first = 1 if len(roles) > 2 and roles[0] == SYSTEM else 0
    head = TRUNCATED if first and cut[0] else 0
    even = (len(roles) - first) // 2 * 2
    renamed = head + DELETE * (len(roles) - first - even)
    for i in range(even):
        renamed += RENAME * (roles[first + i] != USER + i % 2) + TRUNCATED * cut[first + i]
    deleted, pending, pairs, wanted = head, 0, 0, USER
    for role, short in zip(roles[first:], cut[first:]):
        if role != wanted:
            deleted += DELETE
        elif wanted == USER:
            pending, wanted = TRUNCATED * short, ASSISTANT
        else:
            deleted, wanted, pairs = deleted + pending + TRUNCATED * short, USER, pairs + 1
    deleted += DELETE * (wanted == ASSISTANT)
    costs = [DELETE * len(roles)] + [renamed] * (even > 0) + [deleted] * (pairs > 0)
    return gone + min(costs)


class Alignment:
    """The banded table over (turns read, characters left), kept at every `step`th row and refilled in between."""

    def __init__(self, states: str):
        codes = np.array([STATES.index(c) for c in states], np.int64)
        self.n, self.fault, self.initial = len(states), codes // 4, codes % 4
        self.usable = (self.fault == FINE) | (self.fault == CUT)
        # With u usable turns from a row on, the band holds the cells with about u characters left.
        self.left = np.append(np.cumsum(self.usable[::-1])[::-1], 0)
        spare = plain_cost(self.fault, self.initial) - DELETE * int(np.count_nonzero(~self.usable))
        self.fewer, self.more = spare // DELETE, spare // INSERT
        self.step = max(16, math.isqrt(self.n))
        # Targets that begin with s: least cost, and by characters after s the last turn that can be kept as s.
        self.system_cost, self.system = FAR, {}
        row = self.row(self.n, None)
        self.kept = {self.n: row}
        for i in range(self.n - 1, -1, -1):
            if self.initial[i] == SYSTEM and self.usable[i]:
                self.note_system(i, row)
            row = self.row(i, row)
            if i % self.step == 0:
                self.kept[i] = row

    def low(self, i: int) -> int:
        return max(0, int(self.left[i]) - self.fewer)

    def characters(self, i: int) -> np.ndarray:
        return np.arange(self.low(i), int(self.left[i]) + self.more + 1)

    def row(self, i: int, after: np.ndarray | None) -> np.ndarray:
        """Least costs from the cells of row i to the end, from those of the row after it."""
        left = self.characters(i)
        if after is None:
            best = np.where(left == 0, 0, FAR)
        else:
            known = np.full(len(left) + len(after) + 3, FAR)
            base = min(self.low(i) - 1, self.low(i + 1))
            known[self.low(i + 1) - base : self.low(i + 1) - base + len(after)] = after
            at = left - base
            best = known[at] + DELETE
            if self.usable[i]:
                best = np.minimum(best, np.where(left > 0, known[at - 1] + self.keep_cost(i, left), FAR))
        # Insertions run along the row: the least value so far, less 5 for each character.
        best = np.minimum.accumulate(best - INSERT * left) + INSERT * left
        return np.minimum(best, FAR)

    def keep_cost(self, i: int, left: Any) -> Any:
        """Cost of turn i standing for the character with `left` characters left: u if even, a if odd."""
        return RENAME * (left % 2 + USER != self.initial[i]) + TRUNCATED * (self.fault[i] == CUT)

    def note_system(self, i: int, after: np.ndarray) -> None:
        left = self.characters(i + 1)
        total = after + DELETE * i + TRUNCATED * int(self.fault[i] == CUT)
        total = np.where((left % 2 == 0) & (left >= 2) & (after < FAR), total, FAR)
        least = int(total.min())
        if least < self.system_cost:
            self.system_cost, self.system = least, {}
        if least == self.system_cost < FAR:
            for r in left[total == least].tolist():
                self.system.setdefault(r, i)

    def best(self) -> tuple[int, str]:
        """Least cost over all lengths, and the ASCII-least of the audits that have it."""
        top, lengths = self.kept[0], self.characters(0)
        even = np.where(lengths % 2 == 0, top, FAR)
        cost = min(int(even.min()), self.system_cost)
        walks = [(0, r, "") for r in lengths[even == cost].tolist()]
        if self.system_cost == cost:
            # For one length, deleting longest before the system turn gives the least audit.
            walks += [(i + 1, r, "D" * i + "K") for r, i in self.system.items()]
        for start in range(0, self.n, self.step):
            end = min(start + self.step, self.n)
            rows = {end: self.kept[end]}
            for i in range(end - 1, start - 1, -1):
                rows[i] = self.row(i, rows[i + 1])
            walks = [self.walk(rows, end, *w) if start <= w[0] <= end else w for w in walks]
            lead = min(audit for _, _, audit in walks)
            walks = [w for w in walks if lead.startswith(w[2]) or w[2].startswith(lead)]
        return cost, min(audit for _, _, audit in walks)

    def walk(self, rows: dict[int, np.ndarray], end: int, i: int, r: int, audit: str) -> tuple[int, int, str]:
        """The least edits of one length up to row `end`: of those that keep the cost, D comes before I, K and R."""

        def cost(row: int, left: int) -> int:
            at = left - self.low(row)
            return int(rows[row][at]) if 0 <= at < len(rows[row]) else FAR

        edits = []
        while i < end or (i == self.n and r > 0):
            here = cost(i, r)
            if i < end and cost(i + 1, r) + DELETE == here:
                edits.append("D")
                i += 1
            elif r > 0 and cost(i, r - 1) + INSERT == here:
                edits.append("I")
                r -= 1
            else:
                edits.append("K" if r % 2 + USER == self.initial[i] else "R")
                i, r = i + 1, r - 1
        return i, r, audit + "".join(edits)


def cheapest_edits(states: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of turns in these states; among equal ones the ASCII-least audit."""
    return Alignment(states).best() if states else (0, "")


def target(audit: str) -> str:
    """The role initials after these edits: the number of turns that stay decides them."""
    n = len(audit) - audit.count("D")
    return "s" * (n % 2) + "ua" * (n // 2)


def turn_state(role: Column, text: Column, again: Column) -> Column:
    """The character of STATES for a turn; its first fault counts."""
    stripped = F.rtrim(text, F.lit(BLANKS))
    closed = F.right(stripped, F.lit(1)).isin(".", "!", "?")
    fault = F.when(stripped == "", BLANK).when(again, DUPLICATE).when(~closed, CUT).otherwise(FINE)
    initial = F.when(role.startswith("s"), SYSTEM).when(role.startswith("u"), USER)
    initial = initial.when(role.startswith("a"), ASSISTANT).otherwise(OTHER)
    return F.substring(F.lit(STATES), fault * 4 + initial + 1, F.lit(1))


def edit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation its edits in order, from a stream of its states (pass 0) and then its turns (pass 1)."""
    known: dict[str, str] = {}
    started, conv, states, audit, final, at, turn_at, kept = False, None, bytearray(), None, "", 0, 0, 0
    out: list[tuple] = []

    def settle() -> None:
        nonlocal audit, final
        text = states.decode()
        audit = known.get(text)
        if audit is None:
            audit = cheapest_edits(text)[1]
            if len(known) < KEPT_ALIGNMENTS and len(text) < 1000:
                known[text] = audit
        final = target(audit)

    def inserted() -> None:
        nonlocal at, kept
        while at < len(audit) and audit[at] == "I":
            out.append((conv, at, "I", None, "user" if final[kept] == "u" else "assistant", "", None, None))
            at, kept = at + 1, kept + 1

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "pass", "turn", "state", "role", "text")]
        for key, step, turn, code, role, text in zip(*columns):
            if not started or key != conv:
                if audit is not None:
                    inserted()
                started, conv, states, audit, at, turn_at, kept = True, key, bytearray(), None, 0, 0, 0
            if step == 0:
                states += code.encode()
                continue
            if audit is None:
                settle()
            inserted()
            edit, fault, was = audit[at], FAULTS[STATES.index(code) // 4], role
            if edit == "R":
                role = "user" if final[kept] == "u" else "assistant"
            out.append((conv, at, edit, turn, role, text, fault, was))
            at, kept = at + 1, kept + (edit != "D")
        if out:
            yield edit_batch(out, batch.schema.field("conv_id").type)
            out.clear()
    if audit is not None:
        inserted()
        if out:
            yield edit_batch(out, batch.schema.field("conv_id").type)


def edit_batch(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
    names = ["conv_id", "place", "edit", "turn", "role", "text", "fault", "was"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def repair_turns(rows: DataFrame) -> DataFrame:
    """All edits of the cheapest repair: conv_id, place, edit, turn, role and text after it, fault, the role it was.

    The repaired conversation is the rows whose edit is not D, by place. `rows` has conv_id, turn, role and text. A
    conversation's rows come out together and in order.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    filled = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    placed = filled.withColumn("at", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("at")) > 1
    marked = placed.withColumn("state", turn_state(F.col("role"), F.col("text"), again))
    nothing = F.lit(None).cast("string")
    first = F.struct(F.lit(0).alias("pass"), nothing.alias("role"), nothing.alias("text"))
    second = F.struct(F.lit(1).alias("pass"), "role", "text")
    twice = marked.select("conv_id", "turn", "at", "state", F.inline(F.array(first, second)))
    stream = twice.sortWithinPartitions("conv_id", "pass", "at").select("conv_id", "pass", "turn", "state", "role", "text")
    return stream.mapInArrow(edit_rows, f"conv_id {kind}, {EDITS}")


class Digest:
    """Counts and the running hash of one conversation."""

    def __init__(self, conv: Any):
        self.conv, self.audit, self.hash, self.stays = conv, [], hashlib.sha256(), 0
        self.faults, self.illegal, self.cost, self.before = dict.fromkeys(FAULTS, 0), 0, 0, None
        self.least, self.most, self.turns, self.turn = None, None, 0, None

    def add(self, edit: str, turn: int | None, role: str, text: str, fault: str | None, was: str | None) -> None:
        self.audit.append(edit)
        self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": RENAME}[edit]
        if edit != "D":
            self.cost += TRUNCATED * (fault == "truncated")
            self.hash.update(("\n" * (self.stays > 0) + f"{role}:{text}").encode())
            self.stays += 1
        if edit != "I":
            self.faults[fault] += 1
            self.illegal += self.before is not None and self.before + was[:1] not in ("su", "ua", "au")
            self.before = was[:1]
            if turn is not None and turn != self.turn:
                self.least = turn if self.least is None else self.least
                self.most, self.turn, self.turns = turn, turn, self.turns + 1

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        counts = [self.faults[f] for f in ("blank", "duplicate", "truncated")]
        return (self.conv, gaps, *counts, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


DIGEST = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *DIGEST, "audit", "repaired_sha256"]

    def batch_of(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [key, *[pa.int64()] * len(DIGEST), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    digest, done, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "role", "text", "fault", "was")]
        for conv, *edit in zip(*columns):
            if digest is None or conv != digest.conv:
                if digest is not None:
                    done.append(digest.row())
                digest = Digest(conv)
            digest.add(*edit)
        if done:
            yield batch_of(done, kind)
            done = []
    if digest is not None:
        yield batch_of([digest.row()], kind)


def conversation_digests(edits: DataFrame) -> DataFrame:
    """One row per conversation from its edits, which must stand together and in order, as `repair_turns` gives them."""
    kind = edits.schema["conv_id"].dataType.simpleString()
    longs = ", ".join(f"{c} bigint" for c in DIGEST)
    return edits.mapInArrow(digest_rows, f"conv_id {kind}, {longs}, audit string, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text, one row in four damaged or dropped by the checksum of `conv_id:turn`."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    filled = [F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = rows.select("conv_id", "turn", *filled, (F.crc32(key) % 20).alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = conversation_digests(repair_turns(damage(conversations))).withColumnRenamed("conv_id", "found_id")
    ids = conversations.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in DIGEST],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The same repair as an automaton over the four places of the grammar: 0 nothing yet, 1 after s, 2 after a, 3 after u.
# Between two turns one insertion is enough: two in a row add a pair that costs more than any repair without it.
OP11_SQL = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM raw, range(2) AS copies(n) WHERE kind <> 0 AND (n = 0 OR kind = 3)),
placed AS (
  SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM damaged),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again FROM placed),
marked AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered),
inserts(q, q1, fee, sign, line) AS (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
  (0, 3, 5, 'I', 'user:'), (1, 3, 5, 'I', 'user:'), (2, 3, 5, 'I', 'user:'), (3, 2, 5, 'I', 'assistant:')),
moves(q1, move, q2, wanted) AS (VALUES (0, 'D', 0, ''), (1, 'D', 1, ''), (2, 'D', 2, ''), (3, 'D', 3, ''), (0, 'S', 1, 's'),
  (0, 'T', 3, 'u'), (1, 'T', 3, 'u'), (2, 'T', 3, 'u'), (3, 'T', 2, 'a')),
walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS pos, 0 AS q, {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}} AS best FROM damaged
  UNION ALL
  SELECT w.conv_id, m.pos, v.q2,
    min({{'cost': w.best.cost + i.fee + CASE WHEN v.move = 'D' THEN 2
        ELSE (v.move = 'T' AND m.initial <> v.wanted)::BIGINT + 5 * (m.fault = 'truncated')::BIGINT END,
      'audit': w.best.audit || i.sign || CASE WHEN v.move = 'D' THEN 'D' WHEN m.initial = v.wanted THEN 'K' ELSE 'R' END,
      'lines': w.best.lines || CASE WHEN i.line = '' THEN '' ELSE chr(10) || i.line END || CASE WHEN v.move = 'D' THEN ''
        ELSE chr(10) || CASE WHEN m.initial = v.wanted THEN m.role WHEN v.wanted = 'u' THEN 'user' ELSE 'assistant' END
          || ':' || m.text END}})
  FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.pos = w.pos + 1
    JOIN inserts i ON i.q = w.q JOIN moves v ON v.q1 = i.q1
  WHERE v.move = 'D' OR (m.fault IN ('', 'truncated') AND (v.move = 'T' OR m.initial = 's'))
  GROUP BY w.conv_id, m.pos, v.q2),
ends AS (
  SELECT w.conv_id, min({{'cost': best.cost + fee, 'audit': best.audit || sign,
    'lines': best.lines || CASE WHEN line = '' THEN '' ELSE chr(10) || line END}}) AS best
  FROM walk w JOIN inserts i ON i.q = w.q
    JOIN (SELECT conv_id, max(pos) AS pos FROM placed GROUP BY conv_id) l
      ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.pos = w.pos
  WHERE q1 IN (0, 2) GROUP BY w.conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM marked GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
  coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
