"""The text queries run over the smallest tables with their production parameters."""

from __future__ import annotations

import pytest

pytest.importorskip("tiktoken")
from framemill.llm.queries import QUERIES  # noqa: E402
from framemill.registry import table  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(spark, data, name):
    least = 0 if name == "p7_found" else 1  # the smallest tables hold a handful of labels
    assert QUERIES[name](spark, data).count() >= least


def test_every_document_comes_out(spark, data):
    documents = table(spark, data, "documents").select("doc_id")
    for name in ("p5_ids", "p6_containers", "p7_scores"):
        out = QUERIES[name](spark, data).select("doc_id").dropDuplicates()
        assert documents.exceptAll(out).count() == 0 and out.count() == documents.count()
