from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or (doc_id, text, lang, source) rows."""
    def make(rows):
        full = []
        for k, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (k, r)
            full.append(tuple(r) + (None,) * (4 - len(r)) + (None if len(r) < 2 or r[1] is None else len(r[1]),))
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def as_tables(spark, tmp_path):
    """A folder with the given DataFrames as tables, for registered queries."""
    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return make
