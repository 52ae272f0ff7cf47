"""Fixtures of the text operators."""

from __future__ import annotations

import pytest

from touchline.llm.batches import Scratch
from touchline.llm.queries import prepare

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def scratch(spark):
    return Scratch(prepare(spark))


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) rows, over several partitions."""

    def make(rows, lang=None, source="s"):
        full = [(i, t, lang, source, None if t is None else len(t)) for i, t in rows]
        return prepare(spark).createDataFrame(full, DOCS).repartition(3)

    return make
