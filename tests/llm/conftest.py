from pathlib import Path

import pytest

FOLDER = "/root/testdata/sf0.001"
if not Path(FOLDER).exists():
    collect_ignore_glob = ["test_queries.py"]


@pytest.fixture(scope="session")
def folder():
    return FOLDER


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """Documents from (doc_id, text, source) rows, stored as a table is."""
    root = tmp_path_factory.mktemp("docs")
    count = iter(range(10_000))

    def make(rows, extra=""):
        rows = [(i, t, "en", s, len(t or "")) + tuple(more) for i, t, s, *more in rows]
        path = str(root / str(next(count)))
        spark.createDataFrame(rows, DOCS + extra).repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make
