"""Every registered query of the training-data operators, against its SQL where it has some."""

import corpus_pipeline
import pytest

import __spark_entry__ as entry
import compare
from speedloom.llm.queries import ORACLES, QUERIES

CON = {}


@pytest.mark.parametrize("name", [*sorted(QUERIES), "pipeline"])
def test_query(spark, sf_dir, name):
    con = CON.setdefault("con", compare.connect(sf_dir))
    status, _, note = compare.compare(spark, con, name, sf_dir)
    assert status == ("ok" if name in ORACLES else "rows"), note


def test_registration():
    assert set(ORACLES) <= set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "PII", "packing"]
