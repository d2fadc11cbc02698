import uuid

import pytest

from clearledger.llm import common

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def own_work_folder(monkeypatch, tmp_path):
    """Intermediate tables of a test go to its own folder."""
    monkeypatch.setattr(common, "work_folder", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with columns whose names clash with results."""

    def make(pairs, lang="en", source="src0"):
        rows = [(i, t, lang, source, None if t is None else len(t), "x", 7) for i, t in pairs]
        return spark.createDataFrame(rows, f"{DOCS}, kept string, start int")

    return make


ODD_TEXTS = [None, "", " \n\t ", "a", "Ünïcödé ß 漢字 🙂", "x" * 50_000, "word " * 20_000, "\n\n\n", "--- $$$ 123"]


@pytest.fixture
def odd(docs):
    """Null ids and texts, empty and very long texts, repeated rows."""
    pairs = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    return docs([*pairs, *pairs[:5], (None, "no id here"), (None, None)])


@pytest.fixture
def nothing(docs):
    return docs([])
