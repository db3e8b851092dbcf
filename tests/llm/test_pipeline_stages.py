"""The corpus pipeline: every stage against a brute-force version on its own input."""

import random

import corpus_pipeline
from glossa.llm import language_id, mixing
from tokenizers import Tokenizer

from test_text_ops import brute_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _corpus(spark):
    rnd = random.Random(8)
    vocab = {"en": ["the", "of", "and", "thing", "that", "was"], "de": ["der", "die", "und", "schön", "über", "ist"],
             "fr": ["le", "été", "que", "nous", "à", "où"]}
    texts = []
    for i in range(150):
        lang = rnd.choice(["en", "en", "de", "fr"])
        texts.append((lang, " ".join(rnd.choice(vocab[lang]) + rnd.choice("abcdefghij") for _ in range(rnd.randint(12, 60)))))
    rows = []
    for i in range(300):
        lang, t = rnd.choice(texts)
        if i % 3 == 0:
            w = t.split()
            w[rnd.randrange(len(w))] = "changed"
            t = " ".join(w)
        rows.append((i, t, lang if i % 11 else None, f"src{i % 4}", len(t)))
    rows += [(900, None, "en", "s", None), (901, "", "en", "s", 0), (902, "1 2 3", None, None, 5),
             (5, rows[5][1], rows[5][2], rows[5][3], rows[5][4])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_stages(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact dedup", "n-gram join", "mixing", "tokens"] and corpus_pipeline.ORACLE_SQL is None
    docs = _corpus(spark)
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, inputs[-1], str(tmp_path))
        if name != "tokens":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name.replace(" ", "")))
        inputs.append(spark.read.parquet(str(tmp_path / name.replace(" ", ""))))
    rows = [[tuple(r) for r in d.collect()] for d in inputs]
    # language: rows without letters go, clean ones stay
    assert sorted(r[0] for r in rows[0] if r[0] < 900) == sorted(r[0] for r in rows[1])
    # exact dedup: the largest id of each text, once
    largest = {}
    for r in rows[1]:
        largest[r[1]] = max(largest.get(r[1], -1), r[0])
    assert sorted(r[0] for r in rows[2]) == sorted(largest.values())
    # near copies: one document of each component
    comp = brute_components([(r[0], r[1]) for r in rows[2]])
    assert sorted(r[0] for r in rows[3]) == sorted({c for _, c in comp.values()})
    # mixing: as many copies as the fitted rates say
    copies = {r.id: r.copies for r in mixing.document_rates(inputs[3]).collect()}
    assert sorted(r[0] for r in rows[4]) == sorted(i for i, c in copies.items() for _ in range(c))
    # tokens
    from glossa.llm.bpe import default_vocabulary
    t = Tokenizer.from_file(default_vocabulary())
    text = {r[0]: r[1] for r in rows[4]}
    assert all(r.ids == t.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
               for r in inputs[5].collect())


def test_run_and_empty_table(spark, tmp_path):
    _corpus(spark).limit(60).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty = tmp_path / "none"
    _corpus(spark).limit(0).write.parquet(str(empty / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
    assert language_id.MIN_SCORE < 0.5


def test_texts_reach_python_once_and_few_at_a_time(spark):
    """The language stage held 10,000 rows at once, with every text twice."""
    rows_at_once = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows_at_once)
    try:
        for given, held in (("10000", "512"), ("0", "512"), ("32", "32")):
            spark.conf.set(rows_at_once, given)
            accepted = corpus_pipeline.language(spark, _corpus(spark), "")
            assert spark.conf.get(rows_at_once) == held
        plan = accepted._jdf.queryExecution().analyzed().toString()
        assert "MapInArrow" in plan and "__body" not in plan and "__text" not in plan
    finally:
        spark.conf.set(rows_at_once, before)
