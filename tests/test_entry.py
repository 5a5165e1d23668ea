"""The driver contract holds with and without the text-preparation part."""

import importlib
import sys

import __spark_entry__
from workload.queries import QUERIES


def test_registered_queries():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_text_preparation(monkeypatch):
    for name in [m for m in sys.modules if m.split(".")[:2] == ["lacuna", "llm"]] + ["corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name, raising=False)
    monkeypatch.setitem(sys.modules, "lacuna.llm", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    assert set(importlib.import_module("__spark_entry__").queries()) == set(QUERIES)
