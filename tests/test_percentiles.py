"""Percentiles of the length ratio from merged sketches."""

import random

from glossa.operators import qa


def test_merged_sketches_are_within_their_error(spark):
    rng = random.Random(2)
    texts = [(f"r{i % 3}", f"f{min(i % 7, 3)}", "s" * 100, "t" * rng.randint(0, 400)) for i in range(20_000)]
    texts += [("r0", "none", "", "t"), ("r0", "one", "ab", "abcd")]
    df = spark.createDataFrame(texts, "run_id string, filepath string, source_text string, translated_text string")
    sketches = qa.ratio_sketches(df)
    assert sketches.filter("filepath = 'f3'").count() == 3  # one a run
    got = {r.filepath: r for r in qa.ratio_percentiles(sketches, percents=(1, 50, 99)).collect()}
    assert set(got) == {"f0", "f1", "f2", "f3", "one"}  # an empty source has no ratio
    assert (got["one"].n, got["one"].p50) == (1, 2.0)
    for path in ("f0", "f3"):
        ratios = sorted(len(t) / 100 for _, f, _, t in texts if f == path)
        assert got[path].n == len(ratios)
        for p in (1, 50, 99):
            value = got[path][f"p{p}"]
            below, upto = sum(x < value for x in ratios), sum(x <= value for x in ratios)
            assert below <= (p / 100 + 0.01) * len(ratios) and upto >= (p / 100 - 0.01) * len(ratios)
