"""Extraction from locale documents on disk."""

import json

import pytest
from pyspark.sql import functions as F

from glossa.operators.extract import extract_entries, parse_documents, quarantine
from glossa.sources.documents import list_documents, list_raw_documents, read_documents
from helpers import nested, rows, write_docs


def _extract(spark, tmp_path, files):
    root = write_docs(str(tmp_path), files)
    e = extract_entries(read_documents(spark, root))
    return e.orderBy("filepath", "entry_idx", "variant_idx")


def test_extracts_both_variants_female_first(spark, tmp_path):
    e = _extract(spark, tmp_path, {"test.json.json": nested([
        {"secondaryKey": "mill_4", "stringId": 31,
         "femaleVariant": "The wheel turns", "maleVariant": "He turns the wheel"}])})
    assert rows(e, "field", "source_text", "string_key", "string_id") == [
        ("femaleVariant", "The wheel turns", "mill_4", "31"),
        ("maleVariant", "He turns the wheel", "mill_4", "31")]


def test_blank_and_non_string_variants_are_skipped(spark, tmp_path):
    e = _extract(spark, tmp_path, {
        "a.json.json": nested([{"secondaryKey": "hollow", "stringId": 8,
                                "femaleVariant": "", "maleVariant": "   "}]),
        "b.json.json": nested([{"secondaryKey": "shapes", "stringId": 9,
                                "femaleVariant": [1], "maleVariant": False}]),
        "c.json.json": nested([{"secondaryKey": "u", "femaleVariant": "　 ",
                                "maleVariant": "\x1c"}])})
    assert e.count() == 0


def test_string_id_kept_or_null(spark, tmp_path):
    e = _extract(spark, tmp_path, {
        "a.json.json": nested([{"secondaryKey": "key1", "stringId": 42,
                                "femaleVariant": "text", "maleVariant": ""}]),
        "b.json.json": nested([{"secondaryKey": "no_id", "femaleVariant": "text"}]),
        "c.json.json": nested([{"secondaryKey": "f", "stringId": 2.0, "femaleVariant": "t"}])})
    assert rows(e, "filepath", "string_id") == [("a.json.json", "42"), ("b.json.json", None),
                                                ("c.json.json", "2.0")]


def test_malformed_files_are_skipped_and_quarantined(spark, tmp_path):
    root = write_docs(str(tmp_path), {
        "bad.json.json": "][ never closed",
        "junk.json.json": '{"entries": []} trailing',
        "utf.json.json": b'{"entries": ["\xff"]}',
        "bom.json.json": b"\xef\xbb\xbf" + json.dumps({"entries": [{"femaleVariant": "ok"}]}).encode(),
    })
    docs = read_documents(spark, root)
    e = extract_entries(docs)
    assert rows(e, "filepath", "string_key", "source_text") == [("bom.json.json", "unknown", "ok")]
    q = sorted(rows(quarantine(parse_documents(docs)), "filepath", "reason"))
    assert q == [("bad.json.json", "invalid_json"), ("junk.json.json", "invalid_json"),
                 ("utf.json.json", "invalid_utf8")]


def test_multiple_files(spark, tmp_path):
    files = {f"file{i}.json.json": nested([{"secondaryKey": f"key_{i}", "stringId": i,
                                            "femaleVariant": f"Line {i}", "maleVariant": ""}])
             for i in range(3)}
    assert _extract(spark, tmp_path, files).count() == 3


def test_entry_locations_and_key_fallbacks(spark, tmp_path):
    entry = {"femaleVariant": "x"}
    e = _extract(spark, tmp_path, {
        "flat.json.json": {"entries": [entry]},
        "list.json.json": ["junk", 3, {"$type": "T", **entry}],
        "fallback.json.json": {"Data": {"RootChunk": {"root": {"Data": {"entries": {"a": 1}}}}},
                               "entries": [{"secondaryKey": None, **entry}]},
        "nothing.json.json": {"other": [entry]},
        "bool.json.json": {"entries": [{"secondaryKey": True, "stringId": None, **entry}]},
    })
    assert rows(e, "filepath", "entry_idx", "string_key", "string_id") == [
        ("bool.json.json", 0, "True", None), ("fallback.json.json", 0, "None", None),
        ("flat.json.json", 0, "unknown", None), ("list.json.json", 2, "T", None)]


def test_listing_reads_no_content_and_filters_locale(spark, tmp_path):
    root = write_docs(str(tmp_path), {
        "base/tr-tr/a.json.json": {"entries": []}, "base/TR_TR/b.json.json": {"entries": []},
        "base/en-us/c.json.json": {"entries": []}, "base/tr-tr/raw.json": "x",
        "base/tr-tr-old/d.json.json": {"entries": []}})
    listed = list_documents(spark, root, "tr-tr")
    assert sorted(rows(listed, "filepath")) == [("base/TR_TR/b.json.json",), ("base/tr-tr/a.json.json",)]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    assert rows(list_raw_documents(spark, root, "tr-tr"), "filepath") == [("base/tr-tr/raw.json",)]


@pytest.mark.parametrize("bad", [b"   ", b"\n"])
def test_blank_files_are_invalid(spark, tmp_path, bad):
    # zero-byte files are not listed by the file source at all (no entries either way)
    root = write_docs(str(tmp_path), {"e.json.json": bad})
    q = quarantine(parse_documents(read_documents(spark, root)))
    assert rows(q, "reason") == [("invalid_json",)]


def test_duplicate_keys_last_wins(spark, tmp_path):
    raw = '{"entries": [{"secondaryKey": "a", "femaleVariant": "x", "femaleVariant": "y"}]}'
    e = _extract(spark, tmp_path, {"d.json.json": raw})
    assert rows(e, "string_key", "source_text") == [("a", "y")]


def test_extraction_metrics_one_pass(spark, tmp_path):
    from glossa.operators.extract import extraction_metrics
    root = write_docs(str(tmp_path), {
        "a.json.json": nested([{"femaleVariant": "x", "maleVariant": "y"}, 5,
                               {"femaleVariant": " ", "maleVariant": "z"}]),
        "b.json.json": {"entries": []},
        "c.json.json": "broken {",
    })
    got = dict(rows(extraction_metrics(read_documents(spark, root)), "metric", "value"))
    assert got == {"entries": 3, "files": 2, "files_skipped": 1}


def test_documents_that_variant_refuses(spark, tmp_path):
    """NaN is accepted as Python does; an empty id is no id; broken JSON stays out."""
    e = _extract(spark, tmp_path, {
        "nan.json.json": '{"w": NaN, "entries": [{"secondaryKey": "a", "stringId": Infinity, "v": [NaN],'
                         ' "femaleVariant": "x NaN [NaN]"}, 5, {"stringId": "", "maleVariant": "y"}]}',
        "bad.json.json": '{"w": NaN, "entries": [',
    })
    assert rows(e, "filepath", "entry_idx", "string_key", "string_id", "source_text") == [
        ("nan.json.json", 0, "a", "inf", "x NaN [NaN]"), ("nan.json.json", 2, "unknown", None, "y")]


def test_document_beyond_the_variant_limit(spark):
    """A document of 140 MB keeps every entry; no entry alone is near the limit."""
    text = "w" * 1_000_000
    body = '{"entries": [' + ",".join('{"secondaryKey": "k%d", "femaleVariant": "%s"}' % (i, text)
                                      for i in range(140)) + "]}"
    docs = spark.createDataFrame([("big.json.json", body)], "filepath string, content string")
    e = extract_entries(docs)
    assert e.select(F.count("*"), F.sum(F.length("source_text"))).first()[:] == (140, 140_000_000)
