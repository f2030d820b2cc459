"""Operators without a SQL form against plain versions, exact round trips and held-out accuracy, on the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.check import compare, duck
from tidemark.llm import registry
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.graph import components
from tidemark.llm.language import UNKNOWN
from tidemark.llm.merkle import differing
from tidemark.llm.template_html import read_page
from tidemark.llm.textbytes import shingle_sets, split_words, word_hashes
from tidemark.llm.token_codec import decode_blocks, encode_blocks
from tidemark.llm.url_filter import blocked_bloom, filter_urls


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def words(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), sf_dir, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_words_and_shingles():
    texts = ["A b\tC  d e f", "", "one\x0btwo", " x "]
    found = split_words(pa.array(texts))
    assert np.diff(found.first).tolist() == [6, 0, 2, 1]
    assert [bytes(found.data[a:b]) for a, b in zip(found.start, found.end)] == [w for t in texts for w in words(t)]
    same = split_words(pa.array(["ab ab", "ab"]))
    assert len(set(word_hashes(same).tolist())) == 1
    assert [len(s) for s in shingle_sets(pa.array([*texts, "a b c d e a b c d e a b c d e"]))] == [2, 0, 1, 1, 5]


def test_bloom_has_no_false_negatives(spark):
    listed = spark.range(3000).selectExpr("concat('h.org/', id) AS canonical")
    pages = spark.range(6000).selectExpr("id AS page_id", "concat('http://h.org/', id) AS url")
    # Few blocks, so that very many false positives reach the exact join.
    judged = filter_urls(pages, listed, [], blocks=16)
    assert judged.filter("listed = (page_id < 3000)").count() == 6000
    assert blocked_bloom(listed, "canonical", 16).count() == 16


def test_fingerprints(spark, sf_dir, documents):
    got = {r.doc_id: r for r in entry.queries()["op4_document_fingerprints"](spark, sf_dir).collect()}
    order = sorted(documents, reverse=True)
    prints = defaultdict(set)
    for doc, following in zip(order, [*order[1:], order[0]], strict=True):
        text, other, row = documents[doc].text or "", documents[following].text or "", got[doc]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + other[:cut]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint == row.edited_fingerprint) == (text == edited)
        assert (row.near_edited == 1.0) == (text == edited)
        assert (row.near_next == 1.0) == (text == other)
        prints[row.fingerprint].add(text)
    assert all(len(texts) == 1 for texts in prints.values()) and len(prints) == len({d.text or "" for d in documents.values()})


def test_only_equal_texts_are_fully_alike(spark):
    from tidemark.llm.merkle import likeness, with_tree

    pairs = [("alpha beta. gamma delta. ", "gamma delta. alpha beta. "), ("one two. ", "one two. one two. "), ("same", "same"), ("", "")]
    rows = with_tree(with_tree(spark.createDataFrame(pairs, "a string, b string"), "a", "a_"), "b", "b_")
    got = rows.select("a", "b", likeness(rows.a_root, rows.a_codes, rows.b_root, rows.b_codes).alias("near")).collect()
    assert all((r.near == 1.0) == (r.a == r.b) and r.near > 0.9 for r in got)


def test_differing_branches(spark):
    a, b = "one. two\n\n# head\nsame line", "one. too\n\n# head\nsame line"
    from tidemark.llm.merkle import with_tree

    rows = spark.createDataFrame([(a, b)], "a string, b string")
    rows = with_tree(with_tree(rows, "a", "a_"), "b", "b_")
    found = rows.select(differing(rows.a_fingerprint, rows.b_fingerprint).alias("d")).first().d
    assert [tuple(x) for x in found] == [(0, 0)]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_language_held_out(spark, sf_dir, documents):
    rows = entry.queries()["op7_language_id"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != UNKNOWN]
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) / len(held) > 0.97
    assert all(sum(s.n_words for s in r.spans) == len(words(documents[r.doc_id].text)) for r in rows if r.lang_pred != UNKNOWN)


def test_extraction(spark, sf_dir):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for row in entry.queries()["op2_html_extraction"](spark, sf_dir).collect():
        article = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S).group(1)
        blocks = [re.sub(r"<[^>]+>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


def test_noise_by_markup():
    page = (
        "<html><body><div class='cookie-notice'>c</div><header>Site</header><nav>n</nav><div class='has-sidebar'><article>"
        "<header><h1>T &amp; t</h1></header><p>One <b>two<p>three<aside>no</aside><div class=shareBar>s</div><form>f</form>"
        "</article></div><section id='comments'><article class=comment><p>Great</article></section><footer>f</footer>"
    )
    assert [b["text"] for b in read_page(page)[0] if not b["noise"]] == ["T & t", "One two", "three"]


def test_decontamination(spark, sf_dir, documents):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}

    def plain(text):
        return " ".join(w for w in (re.sub(r"^\W+|\W+$", "", w) for w in (text or "").lower().split()) if w)

    wanted = {(d, i) for d, row in documents.items() for i, text in items.items() if plain(text) in plain(row.text)}
    got = {(r.doc_id, r.item_id) for r in entry.queries()["op10_benchmark_decontamination"](spark, sf_dir).collect()}
    assert wanted and got == wanted


def test_reparameterised_questions(spark):
    item = [(1, "If Anna walks 5 km in 2 hours and then Anna walks 5 km more how far did she walk")]
    docs = [
        (1, "x. If Bob walks 7 miles in 3 hours and then Bob walks 7 miles more how far did she walk today"),
        (2, "x. If Bob walks 7 miles in 3 hours and then Cid walks 8 miles more how far did he run today"),
        (3, "Walks 5 km in 2 hours."),
    ]
    frames = (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(item, "item_id bigint, text string"))
    assert [(r.doc_id, r.item_id) for r in contaminated(*frames).collect()] == [(1, 1)]


def test_mix(spark, sf_dir, documents):
    rows = entry.queries()["op8_mix_to_target"](spark, sf_dir).collect()
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for d, r in documents.items()}
    by_source = defaultdict(int)
    for d, r in documents.items():
        by_source[r.source] += sizes[d]
    order = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    capped = {}
    while True:
        free = [s for s in order if s not in capped]
        left, total = sum(by_source.values()) - sum(capped.values()), sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > 3 * by_source[s]]
        if not above:
            break
        capped |= {s: 3 * by_source[s] for s in above}
    targets = {**capped, **{s: left * weight[s] / total for s in free}}
    taken, longest = defaultdict(int), defaultdict(int)
    for r in rows:
        source = documents[r.doc_id].source
        assert r.size == sizes[r.doc_id] and r.source_size == by_source[source] and math.isclose(r.target, targets[source])
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[source] += r.taken
        longest[source] = max(longest[source], r.size)
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in order)
    again = {r.doc_id: r.taken for r in entry.queries()["op8_mix_to_target"](spark, sf_dir).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_codec_round_trip():
    random = np.random.default_rng(5)
    for ids in (
        np.zeros(0, int), np.array([0]), random.integers(0, 49408, 5000), np.repeat(random.integers(0, 1 << 20, 900), 4),
        np.tile(random.integers(0, 300, 50), 200), np.minimum(random.zipf(1.3, 20_000), 49_407), np.full(3000, (1 << 20) - 1),
    ):
        blocks = encode_blocks(ids)
        assert np.array_equal(decode_blocks(blocks), ids)
    assert sum(map(len, encode_blocks(np.tile(random.integers(0, 300, 50), 200)))) < 2 * 10_000 / 4
    broken = bytearray(encode_blocks(random.integers(0, 200, 2000))[0])
    broken[len(broken) // 2] ^= 4
    with pytest.raises(ValueError):
        decode_blocks([bytes(broken)])


def test_token_ids(spark, sf_dir, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in entry.queries()["op9_token_ids"](spark, sf_dir).collect()}
    start = 0
    for doc in sorted(documents):
        ids = np.array([*tokenizer.encode(documents[doc].text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_language_model(spark, sf_dir, documents):
    rows = entry.queries()["op3_lm_scoring"](spark, sf_dir).collect()
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in documents}
    counts = Counter()
    for d, row in documents.items():
        if not held[d]:
            counts.update([*words(row.text), b" "])
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        tokens = [*words(documents[r.doc_id].text), b" "]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens) and math.isclose(r.base_score, base, rel_tol=1e-6)
        assert r.score < 0


def test_quality(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")  # the smallest tables have too few labels to learn from
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = entry.queries()["op6_quality_cotraining"](spark, sf_dir).collect()
    told = [r for r in rows if r.doc_id in labels]
    assert sum((r.score >= 0.5) == (labels[r.doc_id].quality == 1) for r in told) / len(told) > 0.9


def test_pipeline(spark, sf_dir, documents):
    """Each stage's decision is the one of its operator on the stage's own input; the last one keeps every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, sf_dir).cache()
        old, new = Counter(r.doc_id for r in before.collect()), Counter(r.doc_id for r in docs.collect())
        assert set(new) <= set(old) and docs.columns == corpus_pipeline.COLUMNS
        if name != "mixing":
            assert all(new[d] == 1 for d in new)
        else:
            assert max(new.values()) <= 3
        if name == "near_duplicates":
            sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(documents[d].text)) else set() for d in old}
            left = [(d, sets[d]) for d in new if sets[d]]
            assert not any(100 * len(a & b) >= 80 * len(a | b) for i, (_, a) in enumerate(left) for _, b in left[:i])
            dropped = [d for d in old if d not in new]
            assert all(any(100 * len(sets[d] & s) >= 80 * len(sets[d] | s) for e, s in sets.items() if e != d) for d in dropped)
    final = corpus_pipeline.run(spark, sf_dir)
    assert Counter(r.doc_id for r in final.collect()) == Counter(r.doc_id for r in docs.collect())
