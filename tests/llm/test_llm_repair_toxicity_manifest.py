"""Turn repair, toxicity and the Merkle manifest against plain versions, and their results for odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.manifest import FIELDS, build_manifest, leaf_hash, op13_merkle_manifest, prove
from tidemark.llm.turn_repair import CUT, FINE, STATES, cheapest_edits, conversation_digests, damage, repair_turns

# ---- turn repair


def every_repair(states):
    """All (cost, audit) of short conversations, edit by edit."""
    turns = [(STATES.index(c) // 4, STATES.index(c) % 4) for c in states]
    found = []

    def go(i, roles, cost, audit, inserted):
        if i == len(turns):
            ending = "".join(roles)
            pairs = ending.removeprefix("s")
            if ending == "" or (pairs and pairs == "ua" * (len(pairs) // 2)):
                found.append((cost, audit))
        else:
            fault, initial = turns[i]
            go(i + 1, roles, cost + 2, audit + "D", inserted)
            if fault in (FINE, CUT):
                stay = 5 * (fault == CUT)
                go(i + 1, [*roles, "suax"[initial]], cost + stay, audit + "K", inserted)
                for role in "ua":
                    go(i + 1, [*roles, role], cost + stay + 1, audit + "R", inserted)
        if inserted < 3:
            for role in "ua":
                go(i, [*roles, role], cost + 5, audit + "I", inserted + 1)

    go(0, [], 0, "", 0)
    return min(found)


def by_automaton(states):
    """Least cost and audit over four places of the grammar: nothing yet, after s, after a, after u."""
    best = {0: (0, "")}

    def insert():
        for _ in range(2):
            for place, (cost, audit) in list(best.items()):
                to, option = (2 if place == 3 else 3), (cost + 5, audit + "I")
                best[to] = min(best.get(to, option), option)

    for c in states:
        insert()
        fault, initial = STATES.index(c) // 4, STATES.index(c) % 4
        after = defaultdict(list)
        for place, (cost, audit) in best.items():
            after[place].append((cost + 2, audit + "D"))
            if fault in (FINE, CUT):
                stay, wanted = cost + 5 * (fault == CUT), 2 if place == 3 else 1
                keep = initial == wanted
                after[2 if place == 3 else 3].append((stay + (not keep), audit + ("K" if keep else "R")))
                if place == 0 and initial == 0:
                    after[1].append((stay, audit + "K"))
        best = {place: min(options) for place, options in after.items()}
    insert()
    return min(v for place, v in best.items() if place in (0, 2))


def test_repair_of_short_conversations_is_the_best_of_all():
    rng = random.Random(5)
    for _ in range(150):
        states = "".join(rng.choice(STATES[:10]) for _ in range(rng.randint(1, 4)))
        assert cheapest_edits(states) == every_repair(states), states


def test_repair_agrees_with_an_automaton():
    rng = random.Random(7)
    for _ in range(2000):
        states = "".join(rng.choice(STATES if rng.random() < 0.3 else "suauasuauxUA05") for _ in range(rng.randint(1, 20)))
        assert cheapest_edits(states) == by_automaton(states), states
    for states in ("s" * 700, "a" * 301 + "u" * 300, "x" * 500, "0" * 400, "s" + "ua" * 400 + "0", "us" * 333, "US" * 333):
        assert cheapest_edits(states) == by_automaton(states)
    long = "".join(rng.choice("suaxUA04") if rng.random() < 0.2 else "ua"[i % 2] for i in range(3000))
    assert cheapest_edits(long) == by_automaton(long)


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_repaired_conversations(spark):
    rows = [
        (1, 0, "user", "Hi."),
        (1, 1, "assistant", "Yes."),
        (1, 1, "assistant", "Yes."),
        (1, 3, "user", "More?"),
        (2, None, None, None),
        (None, 5, "user", "Alone!"),
        (None, None, "system", "Be nice."),
        (3, 0, "user", "Who are you?"),
        (3, 2, "tool", "x" * 200_000 + "."),
        (4, 0, "", "No role."),
        (4, 1, "user", "cut off"),
    ]
    frame = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("at", "state", "pass", "kind", "edit", "place")})
    edits = repair_turns(frame.repartition(4))
    got = {r.conv_id: r for r in conversation_digests(edits).collect()}
    assert {k: (r.audit, r.cost) for k, r in got.items()} == {
        1: ("KKDD", 4), 2: ("D", 2), None: ("RR", 2), 3: ("KR", 1), 4: ("DD", 4)
    }
    assert (got[1].gaps, got[1].duplicate, got[1].illegal, got[2].blank, got[2].gaps, got[4].truncated, got[4].illegal) == (1, 1, 1, 1, 0, 1, 1)
    assert got[1].repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
    kept = edits.filter("edit <> 'D' AND conv_id = 3").orderBy("place").collect()
    assert [(r.role, r.was, len(r.text)) for r in kept] == [("user", "user", 12), ("assistant", "tool", 200_001)]
    assert conversation_digests(repair_turns(frame.limit(0))).count() == 0


def test_insertion_goes_where_the_audit_says(spark):
    rows = [(1, i, r, "Fine.") for i, r in enumerate(["user", "assistant", "user", "assistant", "user"])]
    rows = [(1, t, r, f"{t}.") for t, r in enumerate(["system", "user"])] + [(2, t, r, f"{t}.") for _, t, r, _ in rows]
    got = repair_turns(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "place").collect()
    assert "".join(r.edit for r in got) == "".join(by_automaton(s)[1] for s in ("su", "uauau"))


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(60) for t in range(4)]
    got = Counter((r.conv_id, r.turn, r.role, r.text) for r in damage(spark.createDataFrame(rows, TURNS)).collect())
    want = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if kind == 1 else "One Two" if kind == 2 else text
        want[(c, t, "user" if kind == 4 else role, text)] += 0 if kind == 0 else 2 if kind == 3 else 1
    assert got == +want


# ---- toxicity


def test_ngrams_are_those_of_a_loop():
    texts = ["Étion, ab\tc", "", None, "xx"]
    owner, slot = toxicity.ngram_slots(pa.array(texts))
    for i, text in enumerate(texts):
        framed = f" {(text or '').lower()} ".replace("\t", " ")
        grams = [framed[a : a + n] for n in toxicity.SIZES for a in range(len(framed) - n + 1)]
        assert np.count_nonzero(owner == i) == len(grams)
        assert len(set(slot[owner == i].tolist())) == len(set(grams))


def test_ratios_and_fit_against_plain_ones():
    ratio, z = toxicity.log_ratios(np.array([4, 0]), np.array([0, 9]), np.array([8, 18]))
    assert ratio == pytest.approx([np.log(5 / 10) - np.log(1 / 20), np.log(1 / 10) - np.log(10 / 20)])
    assert z == pytest.approx(ratio / np.sqrt([1 / 5 + 1, 1 + 1 / 10]))
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.4).astype(float)
    labels = (x @ np.array([2, -1, 0, 1, 0, 3]) + rng.normal(size=300) > 2).astype(float)
    row, feature = np.nonzero(x)
    scale = np.array([1, 0.5, 2, 1, 1, 0.7])
    weights, bias = toxicity.fit_weights(row, feature, scale, labels)
    p = 1 / (1 + np.exp(-(x * scale) @ weights - bias))
    # At the least loss its slope is 0.
    assert np.abs((x * scale).T @ (p - labels) + toxicity.PULL * weights).max() < 1e-3 and abs((p - labels).sum()) < 1e-3


def test_toxicity_of_held_out_documents(spark):
    rows = toxicity.op12_toxicity(spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = Counter((labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels)
    assert held[(1, 1)] >= 0.9 * (held[(1, 1)] + held[(1, 0)]) and held[(0, 1)] <= 0.02 * (held[(0, 0)] + held[(0, 1)])


def test_toxicity_edges(spark):
    rows = [(i, ("you awful rotter " if i % 2 else "a calm fine day ") + f"number {i}") for i in range(40)]
    rows += [(None, "awful rotter"), (100, None), (101, ""), (102, "awful rotter " + "calm words here " * 20_000), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("toxic", "hits", "score", "label")})
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (0, None), (7, 0)], "doc_id bigint, toxic int")
    every = F.lit(True)
    model = toxicity.learn_toxicity(docs, labels, every)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert len(got) == 44 and got[None] > 0.7 and got[9] > 0.7 and got[8] < 0.2 and 0 < got[100] == got[101] < 1
    assert got[102] > 0.3
    for some in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        plain = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, some, every))
        assert plain.select("score").distinct().count() == 1
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


# ---- manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, proofs) of a list of hashes."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 16 * 16 : place // 16 * 16 + 16]
            proofs[i].append((run[: place % 16], run[place % 16 + 1 :]))
            at[i] = place // 16
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], proofs


def plain_manifest(rows):
    lowered = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        members = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[source] = (members, *plain_tree([plain_leaf(r) for r in members]))
    root, tops = plain_tree([trees[s][1] for s in order])
    for source, top in zip(order, tops):
        members, subroot, proofs = trees[source]
        for row, proof in zip(members, proofs):
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                changed = (*row[:4], row[4].translate(lowered))
            folded, siblings = plain_leaf(changed), ""
            for before, after in proof + top:
                folded = sha("".join(before) + folded + "".join(after))
                siblings += "".join(before) + "".join(after)
            yield (row[0], plain_leaf(row), subroot, root, sha(siblings), folded, folded == root)


DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize(
    "sizes",
    [{"a": 1}, {None: 1, "b": 1}, {"a": 16}, {"a": 17, None: 300, "é": 2, "z": 256}, {f"s{i}": 1 + i % 3 for i in range(40)}, {"a": 4200}],
)
def test_manifest_against_a_plain_one(spark, tmp_path, sizes):
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n * 7 % 5003, source, "en" if n % 3 else None, n if n % 4 else None, f"Text É {n}\n" * (n % 3) if n % 5 else None))
    if len(rows) > 20:
        rows += [rows[3], rows[3], (None, rows[0][1], None, None, None), (None, rows[0][1], None, None, "x"), (5, rows[0][1], "", 0, "A" * 300_000)]
    frame = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("leaf", "number", "tree", "at", "id", "hash", "root")})
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect())
    assert got == Counter(plain_manifest(rows))


def test_manifest_of_nothing_and_stored_proofs(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert op13_merkle_manifest(spark, str(tmp_path)).count() == 0
    docs = spark.createDataFrame([(i, "a" if i % 2 else "b", "en", i, f"t{i}") for i in range(50)], DOCS)
    leaves = docs.select("doc_id", "source", leaf_hash({c: F.col(c) for c in FIELDS}).alias("leaf"), F.lit(None).cast("string").alias("now"))
    manifest = build_manifest(leaves, "source", "doc_id")
    rows = prove(manifest, "now").collect()
    assert all(r.folded_root == r.root and len(r.proof) % 64 == 0 for r in rows) and len(rows) == 50
    # Every node but the root names a parent that is there, and its hashes add up to the parent's.
    nodes = manifest.nodes.collect()
    assert {r.parent for r in nodes} - {r.id for r in nodes} == {manifest.root}


# ---- language, as the contract and the pipeline need it


def test_languages_of_odd_documents(spark):
    from corpus_pipeline import language_stage
    from tidemark.llm.language import identify, train

    english, french = "the cat sat on the mat and looked at the garden ", "le chat était assis sur le tapis près de la fenêtre "
    labelled = [(f"{english} {i}", "en") for i in range(20)] + [(f"{french} {i}", "fr") for i in range(20)]
    model = train(spark.createDataFrame(labelled, "text string, lang string"))
    rows = [(1, english * 3 + french * 3), (2, "Привет, как дела"), (3, "你好"), (4, "12 !?"), (5, None), (6, english)]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id bigint, text string"), model, ["doc_id"]).collect()}
    assert got[1].certainty > 0.99 and [s.lang for s in got[1].spans] == ["en", "fr"]
    assert (got[2].lang_pred, got[2].score, got[2].certainty) == (got[3].lang_pred, got[3].score, 0.0) == ("en", 0.0, 0.0)
    assert got[4].lang_pred == got[5].lang_pred == "und" and got[6].lang_pred == "en" and got[6].score > 0.99
    docs = [(i, t, lang, "s", len(t)) for i, (t, lang) in enumerate(labelled)]
    docs += [(100, english * 3 + french * 3, "en", "s", 1), (101, "Привет", None, "s", 6), (102, "12 !?", None, "s", 5), (103, None, None, None, None)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in language_stage(spark, frame, "").collect()}
    assert kept == {*range(40), 100}
    alone = frame.filter("lang = 'en' AND doc_id < 40")  # one language only: nothing is uncertain
    assert language_stage(spark, alone, "").count() == 20
