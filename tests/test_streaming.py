"""ST1: new documents arriving in a folder; a replayed run appends nothing twice."""

import json

import pytest

from glossa.plans import pipeline
from glossa.streaming.incremental import run_incremental
from helpers import nested, write_docs


def test_incremental_runs_pick_up_only_new_files(spark, tmp_path):
    src, log, ckpt = str(tmp_path / "src"), str(tmp_path / "log"), str(tmp_path / "ckpt")
    entry = lambda i: {"secondaryKey": f"k{i}", "stringId": i, "femaleVariant": f"t{i}",
                       "maleVariant": f"t{i}" if i % 2 else f"m{i}"}
    write_docs(src, {f"tr-tr/a{i}.json.json": nested([entry(i)]) for i in range(3)})
    run = lambda: run_incremental(spark, src, log, ckpt, pipeline.echo_translator(), "E", "K",
                                  backoff_base=0, locale="tr-tr")
    run()
    first = spark.read.parquet(log).count()
    assert first == 6
    run()  # nothing new: the checkpoint skips seen files
    assert spark.read.parquet(log).count() == 6
    write_docs(src, {"tr-tr/b.json.json": nested([entry(9)]), "en-us/c.json.json": nested([entry(8)])})
    run()
    out = spark.read.parquet(log)
    assert out.count() == 8
    assert {r.translated_text for r in out.collect()} >= {"[xx] t9", "[xx] m0"}


def test_failed_strings_are_retried(spark, tmp_path):
    """The provider fails for one file's text at first; a later start translates it though
    the checkpoint has moved on."""
    src, log, ckpt = (str(tmp_path / x) for x in ("src", "log", "ckpt"))
    flag = tmp_path / "down"
    flag.write_text("x")
    for name in "abc":
        write_docs(src, {f"{name}.json.json": nested([{"secondaryKey": name, "femaleVariant": f"t-{name}"}])})

    fails = lambda req: flag.exists() and "t-b" in req["texts"]
    run = lambda: run_incremental(spark, src, log, ckpt, pipeline.failing_translator(fails), "E", "K",
                                  batch_size=1, backoff_base=0)
    run()
    assert sorted(r.source_text for r in spark.read.parquet(log).collect()) == ["t-a", "t-c"]
    assert [r.files for r in spark.read.parquet(pipeline.failures_path(log)).collect()] == [["b.json.json"]]
    run()  # still down, nothing new
    flag.unlink()
    run()
    run()
    assert sorted(r.source_text for r in spark.read.parquet(log).collect()) == ["t-a", "t-b", "t-c"]


def test_what_waits_is_taken_from_the_failed_batches(spark, tmp_path):
    """Both variants of a deduped pair wait; an entry that a later one with its key replaces
    does not, for it is never sent."""
    from glossa.streaming.incremental import waiting
    src, log, ckpt = (str(tmp_path / x) for x in ("src", "log", "ckpt"))
    flag = tmp_path / "down"
    flag.write_text("x")
    entry = lambda k, t, **more: {"secondaryKey": k, "femaleVariant": t} | more
    write_docs(src, {"a.json.json": nested([entry("a", "t-a")]),
                     "b.json.json": nested([entry("b", "old"), entry("b", "t-b", maleVariant="t-b")])})
    run = lambda: run_incremental(spark, src, log, ckpt, pipeline.failing_translator(
        lambda req: flag.exists() and "t-b" in req["texts"]), "E", "K", batch_size=1, backoff_base=0)
    run()
    assert sorted((r.field, r.source_text) for r in waiting(spark, log).collect()) == [
        ("femaleVariant", "t-b"), ("maleVariant", "t-b")]
    flag.unlink()
    run()
    assert waiting(spark, log) is None
    assert sorted((r.field, r.source_text) for r in spark.read.parquet(log).collect()) == [
        ("femaleVariant", "t-a"), ("femaleVariant", "t-b"), ("maleVariant", "t-b")]


@pytest.mark.parametrize("log_buckets", [None, 4])
def test_a_micro_batch_reads_few_replies_at_once(spark, tmp_path, monkeypatch, log_buckets):
    """The log is appended from replies in small row groups (a scan decodes one whole group of up
    to 4,096 rows), at the start that fails for half of the batches and at the next one."""
    import pyarrow.parquet as pq

    from glossa.operators import infer
    from glossa.sinks.bucketed_log import open_log
    groups, write = [], infer.materialize

    def seen(df, name, *args, **more):
        out = write(df, name, *args, **more)
        if name.startswith("replies-"):
            for m in (pq.ParquetFile(f.removeprefix("file://")).metadata for f in out.inputFiles()):
                groups.extend(m.row_group(i).num_rows for i in range(m.num_row_groups))
        return out

    monkeypatch.setattr(infer, "materialize", seen)
    src, log, ckpt = (str(tmp_path / x) for x in ("src", "log", "ckpt"))
    write_docs(src, {"a.json.json": nested([{"secondaryKey": f"k{i}", "femaleVariant": f"t{i}"} for i in range(400)])})
    for failing in (lambda r: r["batch_id"] % 2 == 0, lambda r: False):
        run_incremental(spark, src, log, ckpt, pipeline.failing_translator(failing), "E", "K", batch_size=1,
                        backoff_base=0, log_buckets=log_buckets)
    assert sum(groups) == 600 and max(groups) <= infer.REPLIES_AT_ONCE
    rows = open_log(spark, log).read()
    assert sorted(r.translated_text for r in rows.collect()) == sorted(f"[xx] t{i}" for i in range(400))
