import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts: (doc_id, text) or (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns that clash with names
    used inside."""
    fields = "row string, node bigint, bucket string, topic string, tokens bigint, class string"
    schema = T.StructType([*T._parse_datatype_string(DOCS).fields, *T._parse_datatype_string(fields).fields])
    long = " ".join(f"word{i % 977} and{i}" for i in range(20_000))
    extra = ("r", 1, "b", "t", 2, "c")
    rows = [
        (1, None, None, None, None, *extra),
        (2, "", "en", "s", 0, *extra),
        (3, " \n\t\n ", "en", None, 5, *extra),
        (4, long, "en", "s", len(long), *extra),
        (5, long, "en", "s", len(long), *extra),
        (6, "one line that is long enough to count as a passage\nand another one that is long enough", "en", "s", 84, *extra),
        (6, "one line that is long enough to count as a passage\nand another one that is long enough", "en", "s", 84, *extra),
        (None, "a text without any id but with words in it", "de", "s", 41, *extra),
        (7, "\x00 ퟿ \U0001f600 it's", None, "s", 5, *(None,) * 6),
    ]
    return spark.createDataFrame(rows, schema)
