"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import registry
from tidemark.llm.cotraining import score_quality
from tidemark.llm.decontaminate import contaminated, without_contaminated
from tidemark.llm.language import identify, learn
from tidemark.llm.merkle import fingerprint_edits
from tidemark.llm.ngram_join import similar_groups
from tidemark.llm.recurrent_lm import score_documents
from tidemark.llm.template_html import extract_text
from tidemark.llm.token_codec import read_ids, write_ids
from tidemark.llm.token_mix import mix_sources
from tidemark.llm.url_filter import filter_urls

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside: they must not clash.
EXTRA = ["row", "n", "hash", "component_id", "score", "size", "copies", "run", "item_id", "host", "listed"]


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"word{i % 977} of{i % 13}" for i in range(30_000))
    rows = [
        (1, "The cat sat on the mat and looked at the quiet garden outside.", "en", "a", 62),
        (2, None, "en", "a", None),
        (3, "", "fr", None, 0),
        (4, " \t\n ", None, "b", 4),
        (5, "12 34 ...", "en", "b", 9),
        (6, "The cat sat on the mat and looked at the quiet garden outside.", "en", "b", 62),
        (7, "one two", "en", "a", 7),
        (7, "one two", "en", "a", 7),
        (None, "a row without an id", "en", "a", 19),
        (8, long, "en", None, len(long)),
        (9, "Le chat était assis sur le tapis, près de la fenêtre ouverte.", "fr", "c", 61),
    ]
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({c: F.lit("x") for c in EXTRA}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, None), (None, 1, 1), (1, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "cat sat on the mat and looked at the quiet garden"), (2, None), (3, ""), (4, "one two"), (None, "!")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://WWW.Example.COM/en/x?b=2&a=1#f"), (4, "http://x.net"), (4, "http://x.net")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({c: F.lit(1) for c in ("listed", "verdict", "w0", "block")})
    listed = spark.createDataFrame([("x.net",), (None,), ("x.net",)], "canonical string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, listed, [("block", "com", "/")]).collect()}
    assert got == {(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "www.example.com", "/en/x", "com/", "block"), (4, "x.net", "", None, "block")}
    assert filter_urls(pages, listed.limit(0), []).filter("verdict = 'block'").count() == 0
    assert filter_urls(pages.limit(0), listed, []).count() == 0
    assert filter_urls(pages, listed, []).count() == 5


def test_pages(spark):
    site = "<div class=x9>Sign up now</div>"
    rows = [(i, f"http://a.org/{i}", f"<body><nav>m</nav>{site}<div>Own &amp; text\n {i}<p>more {i}</div>") for i in range(4)]
    rows += [(10, None, None), (11, "http://b.org/", ""), (12, "http://b.org/", "<p>one<br>two<p>three<scr"), (12, "http://b.org/", "<p>one<br>two<p>three<scr")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit(1) for c in ("text", "host", "row", "code")})
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract_text(pages).collect())
    assert got[:4] == [(i, f"Own & text {i}\n\nmore {i}", 20) for i in range(4)]
    assert got[4:] == [(10, "", 0), (11, "", 0), (12, "one two\n\nthree", 14), (12, "one two\n\nthree", 14)]
    assert extract_text(pages.limit(0)).count() == 0


def test_ids_and_repeated_blocks_inside_articles(spark):
    """Ids name headings and sections; a block that few of many pages of a host share is text."""
    inside = '<h2 id="social-policy">Social policy</h2><section id="related-work"><p>Related.</p></section><div class="share">x</div>'
    shared = "<ul><li>one</li><li>two</li></ul>"
    rows = [(i, f"http://h.org/{i}", f"<article><p>Own words {i}.</p>{shared if i < 12 else ''}</article>") for i in range(200)]
    rows += [(900, "http://k.org/", f"<article>{inside}</article>")]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[900] == "Social policy\n\nRelated."
    assert all(got[i] == f"Own words {i}." + ("\n\none\n\ntwo" if i < 12 else "") for i in range(200))


def test_language(docs, empty):
    model = learn(docs)
    got = {(r.doc_id, r.lang_pred) for r in identify(docs, model, ["doc_id"]).collect()}
    assert {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "und"), (9, "fr")} <= got
    assert len(got) == 10
    assert identify(docs, learn(empty), ["doc_id"]).filter("lang_pred = 'und' AND score = 0").count() == 11
    assert identify(empty, model, ["doc_id", "text"]).count() == 0


def test_fingerprints(docs, empty):
    rows = fingerprint_edits(docs).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[6].fingerprint and by_id[2].fingerprint == by_id[3].fingerprint
    assert by_id[4].near_edited < 1 and by_id[3].near_next == 1.0 and by_id[2].n_chars == 0 and by_id[1].near_edited < 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprint_edits(empty).count() == 0
    assert fingerprint_edits(docs.filter("doc_id = 7")).first().near_next == 1.0


def test_similar(docs, empty):
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in similar_groups(docs).collect())
    assert [g for g in got if g[0] in (1, 2, 3, 4, 6, 7)] == [(1, 9, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (6, 9, 1), (7, 1, 7), (7, 1, 7)]
    assert got[0] == (-1, 1, None) and len(got) == 11
    assert similar_groups(empty).count() == 0


def test_contaminated(docs, empty, benchmark):
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()}
    assert got == {(1, 1), (6, 1), (7, 4)}
    assert without_contaminated(docs, benchmark).count() == 7
    assert contaminated(docs, benchmark.limit(0)).count() == 0 and contaminated(empty, benchmark).count() == 0


def test_mix(docs, empty):
    rows = mix_sources(docs).collect()
    assert len(rows) == 11 and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - sum(r.size for r in rows)) < 1e-6
    assert mix_sources(empty).count() == 0
    assert mix_sources(docs.filter("doc_id = 2")).first().target == 0


def test_token_ids(docs, empty):
    rows = sorted(read_ids(write_ids(docs, tokenizer())).collect(), key=lambda r: r.start)
    assert len(rows) == 11 and rows[0].doc_id is None and rows[0].start == 0
    assert [b.start for b in rows[1:]] == [a.start + a.n_tokens for a in rows[:-1]]
    assert [r.ids for r in rows if r.doc_id in (2, 3, 4)] == [[1]] * 3
    assert read_ids(write_ids(empty, tokenizer())).count() == 0


def test_scores(docs, empty, labels):
    rows = score_documents(docs).collect()
    assert len(rows) == 11 and all(r.score < 0 and r.base_score <= 0 and r.n_known <= r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert score_documents(empty).count() == 0
    quality = score_quality(docs, labels).collect()
    assert len(quality) == 11 and all(0 <= r.score <= 1 and 0 <= r.toxic_score <= 1 for r in quality)
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert score_quality(empty, labels).count() == 0


def test_scores_without_training(docs):
    held = docs.filter("crc32(string(doc_id)) % 7 = 2")
    assert all(r.score < 0 and r.base_score == 0 and r.train_tokens == 0 for r in score_documents(held).collect())


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, empty, sf_dir, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    assert function(spark, empty, sf_dir).count() == 0
    found = function(spark, docs, sf_dir)
    if stage != "token_ids":
        assert found.columns == corpus_pipeline.COLUMNS
    kept = {"language": 7, "near_duplicates": 9, "decontamination": 11, "token_ids": 11}
    assert stage not in kept or found.count() == kept[stage]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))
