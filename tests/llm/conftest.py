"""Small tables with everything odd in them."""

import duckdb
import pytest
from pyspark.sql import functions as F

LONG = "word " * 30_000 + "x" * 20_000

ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "two words",
    "Same text, twice.",
    "Same text, twice.",
    "123 456 !!!",
    "Ünïcödé Σίσυφος é İstanbul 日本語テキスト \U0001f600",
    "control \x00 \x1c \x85 ​ chars <|endoftext|> </s>",
    LONG,
]
CLASHING = [
    "score", "found", "fp", "row", "h", "w", "text_hash", "held_out", "lang_pred", "n_tokens",
    "component", "component_id", "fingerprint", "count", "word", "item_id", "label", "k", "f",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with ids that repeat or are null, and clashing extra columns."""
    rows = [(i, text) for i, text in enumerate(ODD_TEXTS)]
    rows += [(3, "three words here"), (None, "no id"), (None, None), (5, "Same text, twice.")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    lang = F.when(F.col("doc_id") % 3 == 0, None).otherwise("en")
    return frame.withColumns({"lang": lang, **{name: F.lit("clash") for name in CLASHING}})


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("doc_id < -1")


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows_of():
    def read(path, columns="*"):
        return duckdb.connect().execute(f"SELECT {columns} FROM read_parquet('{path}')").fetchall()

    return read
