"""Gates (A8-A12) and multi-folder reads."""

import pytest
from pyspark.sql import functions as F

from glossa.operators import gates
from glossa.sources.documents import read_documents_from
from helpers import nested, rows, write_docs


def _outcomes(spark, oks):
    return spark.createDataFrame([(i, ok) for i, ok in enumerate(oks)], "i int, ok boolean")


def test_rate_gate_is_strict(spark):
    assert gates.failure_rate_gate(_outcomes(spark, [False] + [True] * 9))["pct"] == 10.0
    with pytest.raises(gates.GateError, match="too high"):
        gates.failure_rate_gate(_outcomes(spark, [False, False] + [True] * 9))


def test_all_failed_gate(spark):
    gates.all_failed_gate(_outcomes(spark, [False, True]))
    with pytest.raises(gates.GateError, match="All 2"):
        gates.all_failed_gate(_outcomes(spark, [False, False]))


def test_non_empty_and_header_gates(spark):
    with pytest.raises(gates.GateError):
        gates.non_empty_gate(_outcomes(spark, []).filter(F.col("ok")), "locale files")
    with pytest.raises(ValueError, match="absent: string_id"):
        gates.header_gate(["filepath", "string_key"])
    with pytest.raises(ValueError, match="absent"):
        gates.header_gate([])


def test_read_from_several_folders(spark, tmp_path):
    base = write_docs(str(tmp_path / "content"), {"tr-tr/a.json.json": nested([])})
    ep1 = write_docs(str(tmp_path / "ep1"), {"tr-tr/b.json.json": nested([])})
    df = read_documents_from(spark, [base, str(tmp_path / "missing"), ep1], "tr-tr")
    assert sorted(rows(df, "filepath")) == [("tr-tr/a.json.json",), ("tr-tr/b.json.json",)]
