from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_helpers import AWKWARD, LLM_SMALL  # noqa: E402

SMALL = LLM_SMALL  # tests one folder up import this name from whichever conftest was loaded last


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{LLM_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators use themselves."""
    rows = [(i, t, "x", None, 1.0, 7) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, score double, node int")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{LLM_SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
