"""Every operator and stage on awkward rows and on empty tables, and that both are repeatable."""

from collections import Counter

import pytest

import corpus_pipeline
from barloom.llm import (bpe, decontam, divergence, line_dedup, merkle, pieces, ppm, quality, secret_scan, shards, simhash,
                         suffix_dedup, url_filter)
from tests.llm.conftest import sorted_rows

PER_ROW = {
    "shards": shards.assign_documents,
    "secrets": secret_scan.report,
    "sentencepiece": pieces.encode,
    "suffixes": suffix_dedup.digest,
    "trimmed": suffix_dedup.trim,
    "quality": quality.judge,
    "ppm": ppm.score,
    "simhash": simhash.near_duplicates,
    "merkle": merkle.audit,
    "bpe": bpe.digest,
    "bpe_ids": bpe.encode,
}


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame(
        [(1, "the of and river stone house walked under seven bridges"), (2, None), (None, "one"), (3, "")],
        "item_id long, text string")


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(name, nasty):
    got = PER_ROW[name](nasty)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in nasty.collect())


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(name, nasty):
    empty = PER_ROW[name](nasty.where("false"))
    assert empty.collect() == [] and empty.columns == PER_ROW[name](nasty.limit(1)).columns


def test_line_report_has_each_id_once(nasty):
    got = line_dedup.report(nasty).collect()
    assert Counter(r.doc_id for r in got) == Counter({r.doc_id for r in nasty.collect()})
    assert {r.doc_id: r.n_removed for r in got}[2] == 1
    assert line_dedup.report(nasty.where("false")).collect() == []


def test_decontamination(nasty, benchmark):
    assert {r.doc_id for r in decontam.matches(nasty, benchmark).collect()} <= {r.doc_id for r in nasty.collect()}
    assert decontam.matches(nasty.where("false"), benchmark).collect() == []
    assert decontam.matches(nasty, benchmark.where("false")).collect() == []
    assert decontam.matches(nasty, benchmark.where("text IS NULL OR text = ''")).collect() == []


def test_items_without_an_id(spark, docs):
    item = "seven bridges under the cold morning light"
    rows = docs([(1, f"once {item} again"), (2, "nothing of the kind here")])
    benchmark = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.edits) for r in decontam.matches(rows, benchmark).collect()] == [(1, None, 0)]
    assert [r.doc_id for r in decontam.keep_clean(rows, benchmark).collect()] == [2]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_and_rows(name, stage, spark, nasty, testdata):
    kept = stage(spark, nasty, testdata)
    assert kept.schema.simpleString() == nasty.schema.simpleString()
    others = [c for c in nasty.columns if c != "text"]
    assert set(sorted_rows(kept.select(others))) <= set(sorted_rows(nasty.select(others)))
    assert stage(spark, nasty.where("false"), testdata).collect() == []


def test_last_stage(spark, nasty, testdata):
    assert corpus_pipeline.STAGES[-1][1](spark, nasty, testdata).count() == nasty.count()


def test_divergence_groups(nasty):
    got = divergence.compare(nasty, least=1).collect()
    groups = {(r.lang or "", r.source or "") for r in nasty.collect()}
    several = {g for g in groups if sum(g[0] == h[0] for h in groups) > 1}
    assert {(r.lang, r.source) for r in got if r.part == "pair"} == several
    assert all(r.lang in ("en", "de", "fr", "ja", "") for r in got if r.part == "term" and r.lang != "xx")
    assert {(r.item, r.value) for r in divergence.compare(nasty, least=99).collect()} == {
        (s, 0) for lang, s in several}
    assert divergence.compare(nasty.where("false")).collect() == []


def test_url_rows(spark):
    rows = [(1, "http://a.example.net/en/x"), (2, None), (None, "no scheme"), (3, "http://A.Example.NET"),
            (3, "x://net/?q"), (4, "http://example.com/de"), (5, "s://q.org/fr/#"), (6, ""), (6, "")]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in rows],
                                  "page_id long, url string, host string, verdict string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == {
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "", "", None, "allow"),
        (None, "", "", None, "allow"), (3, "a.example.net", "", None, "allow"), (3, "net", "/", "net/", "block"),
        (4, "example.com", "/de", None, "allow"), (5, "q.org", "/fr/", "org/fr/", "allow"), (6, "", "", None, "allow")}
    assert url_filter.judge(pages.where("false")).collect() == []
