import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(os.path.dirname(HERE))
sys.path[:0] = [ROOT, HERE, os.path.dirname(HERE)]

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing columns."""
    long_text = "The quick brown fox, jumps over the lazy dog. " * 3000
    rows = [
        (1, "one two three four", "en", "a", 18), (2, "one two three four", "en", "a", 18),
        (2, "one two three four", "en", "a", 18), (3, None, "en", "a", 0), (4, "", None, None, 0),
        (None, "no id here at all", "de", "b", 17), (None, None, None, None, None),
        (5, " \t\n ", "fr", "b", 4), (6, long_text, "en", "a", len(long_text)),
        (7, "Éa übel ñ 42 \x00 <|endoftext|> 7", "es", "c", 10), (8, "x", "en", "a", 1),
    ]
    extra = ["shard", "slot", "fp", "same", "first", "n", "kept", "score", "text_hash", "words", "row"]
    schema = DOCS + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(*r, *["clash"] * len(extra)) for r in rows], schema)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
