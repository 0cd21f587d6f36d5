import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents; a text is the whole row, ids count up, and a clashing column is always there."""

    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, s, None if t is None else len(t), "x", "y") for i, t, s in zip(ids, texts, sources, strict=True)]
        schema = "doc_id long, text string, source string, n_chars long, key string, label string"
        return spark.createDataFrame(rows, schema).repartition(3)

    return make
