import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and blank texts, repeated rows, a long text, clashing extra columns."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [
        (1, "the same few words again and again", "a", 7, "x"),
        (1, "the same few words again and again", "a", 7, "x"),
        (2, "The SAME few words again and again", "b", 8, None),
        (3, None, None, None, None),
        (4, "", "a", 1, "x"),
        (None, " \t\n\x0b", None, 1, "x"),
        (None, "one word", "a", 1, "x"),
        (5, long, "a", 1, "x"),
        (6, long + " end", "c", 1, "x"),
        (7, "é ü ñ 漢字 \U0001f600", "c", 1, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint, _id string")
