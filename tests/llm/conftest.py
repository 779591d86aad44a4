import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"

ODD = [None, "", " ", "a", "A b c  d\n\n e\t", "x" * 5000, "don't it's 12 + ½ 中文 😀 é", "<|endoftext|>", "hi<|endoftext|>  <|endoftext|>\n",
       "the cat sat on the mat " * 3000, "same row", "same row"]


@pytest.fixture(scope="session")
def spark():
    from tradelens.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")})
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    """The small documents table and odd rows: null, empty, long, repeated,
    a null and a repeated doc_id."""
    small = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(1_000_000 + i, t, None, None, None) for i, t in enumerate(ODD)] + [(1_000_011, "same row", None, None, None), (None, "no id", None, None, None)]
    return small.unionByName(spark.createDataFrame(rows, DOCS))


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
