from __future__ import annotations

import pytest

from rolemart.llm.registry import find_package

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    find_package(spark)


@pytest.fixture(scope="session")
def sample(spark):
    """(doc_id, text) of the smallest driver table."""
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """Write small tables as a data folder: name -> (DDL, rows)."""

    def write(**tables):
        path = str(tmp_path_factory.mktemp("tables"))
        for name, (ddl, rows) in tables.items():
            spark.createDataFrame(rows, ddl).coalesce(2).write.parquet(f"{path}/{name}.parquet")
        return path

    return write


def doc_rows(*texts, start=1):
    return [(start + i, t, "en", "src0", len(t) if t is not None else None) for i, t in enumerate(texts)]
