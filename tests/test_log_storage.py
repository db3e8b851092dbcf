"""Bucketed log, stop rule by slices, CSV byte ranges, published versions, waiting strings."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from glossa.operators import infer
from glossa.plans import pipeline
from glossa.schemas import TRANSLATION_LOG
from glossa.sinks import files, manifests
from glossa.sinks.bucketed_log import BucketedLog, bucket_of, is_bucketed
from glossa.sources import csv_splits
from glossa.sources.logs import read_log_csv
from glossa.streaming.incremental import run_incremental, waiting
from helpers import nested, rows, write_docs

ENTRY = "filepath string, entry_idx int, variant_idx int, field string, string_key string, string_id string, source_text string"


def _log(spark, keys, run="r1", text="t", status="translated"):
    return spark.createDataFrame(
        [(run, i, 0, 0, path, key, sid, "femaleVariant", "s", f"{text}{i}", status)
         for i, (path, key, sid) in enumerate(keys)], TRANSLATION_LOG)


def _entries(spark, keys):
    return spark.createDataFrame([(p, 0, 0, "femaleVariant", k, s, "s") for p, k, s in keys], ENTRY)


KEYS = [(f"f{i % 40}", f"k{i}", None if i % 3 else str(i)) for i in range(400)]


def test_bucketed_log_resumes_from_the_buckets_it_needs(spark, tmp_path):
    log = BucketedLog(spark, str(tmp_path / "log"), n_buckets=16)
    log.append(_log(spark, KEYS[:100]))
    log.append(_log(spark, KEYS[100:200], "r2"))
    log.compact()
    log.append(_log(spark, KEYS[200:300], "r3"))
    log.append(_log(spark, KEYS[300:], "r4", status="preview"))
    entries = _entries(spark, KEYS)
    assert sorted(rows(log.pending(entries), "string_key")) == sorted((k,) for _, k, _ in KEYS[300:])
    few = entries.filter("filepath in ('f1', 'f2')")
    touched = {r[0] for r in few.select(bucket_of(16)).distinct().collect()}
    plan = log.for_entries(few)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert len(touched) < 16 and "PartitionFilters: [bucket" in text
    read = {int(r[0].split("bucket=")[1].split("/")[0]) for r in plan.select(F.input_file_name()).distinct().collect()}
    assert read <= touched
    assert sorted(rows(log.pending(few), "string_key")) == sorted(
        (k,) for p, k, _ in KEYS[300:] if p in ("f1", "f2"))


def test_history_stays_and_the_last_record_wins(spark, tmp_path):
    log = BucketedLog(spark, str(tmp_path / "log"), n_buckets=4, compact_after=2)
    log.append(_log(spark, KEYS[:5], "r1", "old"))
    log.append(_log(spark, KEYS[:5], "r2", "new"))  # compacts
    state = log.state()
    assert state.deltas == () and len(state.folded) == 2 and state.snapshot
    assert sorted(rows(log.latest(), "translated_text")) == [(f"new{i}",) for i in range(5)]
    assert log.read().count() == 10
    log.compact()  # nothing to fold
    assert log.state() == state


def test_torn_generations_and_other_writers(spark, tmp_path):
    root = str(tmp_path / "log")
    log = BucketedLog(spark, root, n_buckets=4)
    assert not is_bucketed(spark, root) and log.read().count() == 0 and log.pending(_entries(spark, KEYS)).count() == 400
    log._write(_log(spark, KEYS), 4)  # written, never committed
    assert not is_bucketed(spark, root) and log.read().count() == 0
    log.append(_log(spark, KEYS[:10]))
    assert not manifests.commit(spark, root, log.state().number, {"n_buckets": 4})  # taken
    # a writer that commits between another's read and commit: both appends are kept
    other, first = BucketedLog(spark, root), log.state
    calls = []

    def state():
        seen = first()
        if not calls:
            calls.append(1)
            other.append(_log(spark, KEYS[10:20], "r2"))
        return seen

    log.state = state
    name = log._write(_log(spark, KEYS[20:30], "r3"), 4)
    log._replace(lambda s: __import__("dataclasses").replace(s, deltas=(*s.deltas, name)))
    assert other.read().count() == 30 and other.n_buckets != other.state().n_buckets == 4


def test_compaction_gives_way_to_another(spark, tmp_path, monkeypatch):
    log = BucketedLog(spark, str(tmp_path / "log"), n_buckets=4)
    log.append(_log(spark, KEYS[:10]))
    write = BucketedLog._write

    def slow(self, frame, n):
        monkeypatch.setattr(BucketedLog, "_write", write)
        BucketedLog(spark, log.root).compact()
        return write(self, frame, n)

    monkeypatch.setattr(BucketedLog, "_write", slow)
    log.compact()
    assert log.state().deltas == () and len(log.state().folded) == 1
    assert log.read().count() == log.latest().count() == 10


@pytest.mark.parametrize("fails_at,called,kept", [(0, 2, 0), (4, 6, 4), (99, 20, 20)])
def test_frontier_calls_nothing_beyond_the_failing_slice(spark, tmp_path, fails_at, called, kept):
    reqs = spark.createDataFrame([(i, 1, f"p{i}", [f"t{i}"]) for i in range(20)],
                                 "batch_id long, n int, prompt string, texts array<string>")
    seen = tmp_path / "calls"
    seen.mkdir()

    def factory():
        def fn(req):
            (seen / f"{req['batch_id']}-{req['attempt']}").write_text("x")
            if req["batch_id"] == fails_at:
                raise RuntimeError("down")
            return json.dumps(req["texts"])
        return fn

    out = infer.run_frontier(reqs, factory, 2, 0, parallelism=2)
    assert out.count() == called == len({p.name.split("-")[0] for p in seen.iterdir()})
    assert len(list(seen.iterdir())) == called + (fails_at < 20)  # two attempts of the failing batch
    assert infer.stop_at_first_failure(out).count() == kept


def test_job_stops_at_the_first_failure_and_resumes(spark, tmp_path):
    entries = _entries(spark, [(f"f{i:02d}", f"k{i:02d}", None) for i in range(12)])
    path = str(tmp_path / "log")
    run = lambda fails: pipeline.run_translation_job(
        entries, path, pipeline.failing_translator(fails), "E", "K", batch_size=1, wave_batches=4, max_attempts=1,
        backoff_base=0, stop_on_failure=True, parallelism=2, log_buckets=4, run_id=f"r{random.random()}")
    assert run(lambda r: "s" in r["texts"] and r["batch_id"] == 5) == 2
    log = BucketedLog(spark, path)
    assert log.read().count() == 5
    assert rows(spark.read.parquet(pipeline.failures_path(path)), "batch_id") == [(5,)]
    run(lambda r: False)
    assert sorted(rows(log.read(), "string_key")) == [(f"k{i:02d}",) for i in range(12)]


def _csv(n, seed, end="\n"):
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["field", "filepath", "string_key", "string_id", "source_text", "translated_text", "more"])
    for i in range(n):
        text = "".join(rng.choice(['"', "\n", ",", "é", "x", " ", "😀", '""', "\n\n"]) for _ in range(rng.randint(0, 60)))
        writer.writerow(["f", f"p{i}", f"k{i}", rng.choice(["", str(i)]), text, rng.choice(["", text]), "m"])
        if rng.random() < 0.1:
            out.write(end)  # a blank line
    return out.getvalue()


@pytest.mark.parametrize("split", ["7", "64", "1000", "128m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_ranges_equal_python_at_any_split(spark, tmp_path, split, end):
    folder = tmp_path / "log"
    folder.mkdir()
    want = []
    for name, text in (("a.csv", "﻿" + _csv(40, 1, end)), ("b.csv", _csv(25, 2, end)), ("c.csv", _csv(0, 3, end))):
        (folder / name).write_bytes(text.encode())
        for r in csv.DictReader(io.StringIO(text.lstrip("﻿"), newline="")):
            want.append((f"imported:{name}", r["filepath"], r["string_id"] or None, r["source_text"], r["translated_text"],
                         "translated" if r["translated_text"] else "preview"))
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = csv_splits.read_log_csv_splits(spark, str(folder))
        got = [tuple(r) for r in df.orderBy("run_id", "batch_id").select(
            "run_id", "filepath", "string_id", "source_text", "translated_text", "status").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want


def test_csv_ranges_without_broadcast(spark, tmp_path, monkeypatch):
    (tmp_path / "log.csv").write_text(_csv(30, 4))
    read = lambda: sorted(rows(csv_splits.read_log_csv_splits(spark, str(tmp_path / "log.csv"))), key=repr)
    want = read()
    monkeypatch.setattr(csv_splits, "BROADCAST_RANGES", -1)
    assert want and read() == want
    same = rows(read_log_csv(spark, str(tmp_path / "log.csv")).drop("batch_id"))
    assert sorted(same, key=repr) == sorted((r[:1] + r[2:] for r in want), key=repr)


def test_csv_ranges_refuse_bad_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text("filepath,string_key,string_id,field,source_text,translated_text\na,b,c,d,\"e,f\n")
    with pytest.raises(Exception, match="unexpected end of data"):
        csv_splits.read_log_csv_splits(spark, str(tmp_path / "open.csv")).collect()
    (tmp_path / "less.csv").write_text("filepath,string_key\na,b\n")
    with pytest.raises(ValueError):
        csv_splits.read_log_csv_splits(spark, str(tmp_path / "less.csv"))
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(ValueError):
        csv_splits.read_log_csv_splits(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        csv_splits.read_log_csv_splits(spark, str(tmp_path / "absent.csv"))


def test_readers_see_published_versions_only(spark, tmp_path):
    root = str(tmp_path / "out")
    docs = lambda text: spark.createDataFrame([("a", text)], "filepath string, content string")
    assert files.read_published(spark, root) is None
    first = files.write_published(docs("1"), root)
    files.write_documents(docs("unpublished"), root, version="u")
    assert rows(files.read_published(spark, root), "content") == [("1",)]
    second = files.write_published(docs("2"), root, expected=first)
    with pytest.raises(files.VersionConflict):
        files.write_published(docs("late"), root, expected=first)
    assert rows(files.read_published(spark, root), "content") == [("2",)]
    assert rows(files.read_published(spark, root, first), "content") == [("1",)]
    assert files.published_number(spark, root) == second == 1
    with pytest.raises(FileNotFoundError):
        files.publish_version(spark, root, "absent")


@pytest.mark.parametrize("buckets", [None, 8])
def test_failed_strings_wait_once_each(spark, tmp_path, buckets):
    """Three failing starts, NULL ids, new files between them: no string waits twice."""
    src, log, ckpt = (str(tmp_path / x) for x in ("src", "log", "ckpt"))
    flag = tmp_path / "down"
    flag.write_text("x")
    run = lambda: run_incremental(
        spark, src, log, ckpt, pipeline.failing_translator(lambda r: flag.exists() and "ok" not in r["texts"][0]), "E", "K",
        batch_size=1, backoff_base=0, log_buckets=buckets)
    for i in range(3):
        write_docs(src, {f"{i}.json.json": nested([{"secondaryKey": f"k{i}", "femaleVariant": f"t{i}"},
                                                   {"secondaryKey": "o", "femaleVariant": f"ok{i}"}])})
        run()
        assert sorted(rows(waiting(spark, log), "source_text")) == [(f"t{j}",) for j in range(i + 1)]
    flag.unlink()
    run()
    assert waiting(spark, log) is None
    run()
    out = BucketedLog(spark, log).read() if buckets else spark.read.parquet(log)
    assert sorted(rows(out, "source_text")) == sorted([(f"{p}{i}",) for i in range(3) for p in ("t", "ok")])

def test_preview_and_collisions(spark, tmp_path):
    from glossa.operators import apply, dedup
    keys = [("f1", "a", None), ("f1", "a", ""), ("f1", "b", None), ("f2", "a", "1")]
    entries = _entries(spark, keys)
    assert rows(dedup.key_collisions(entries)) == [("f1", 1, 2)]  # '' and NULL are one id
    for buckets in (None, 4):
        path = str(tmp_path / f"log{buckets}")
        pipeline.write_preview(entries, path, "p1", buckets)
        log = BucketedLog(spark, path) if buckets else None
        seen = log.read() if log else spark.read.parquet(path)
        assert sorted(rows(seen, "string_key", "status")) == sorted((k, "preview") for _, k, _ in keys)
        if log:
            assert log.pending(entries).count() == 4
            log.compact()
            assert log.pending(entries).count() == 4
    docs = spark.createDataFrame([("x", "{"), ("y", "[]"), ("z", "{")], "filepath string, content string")
    log = spark.createDataFrame([("x",), ("y",)], "filepath string")
    assert rows(apply.quarantine_touched(docs, log)) == [("x", "apply", "invalid_json")]
