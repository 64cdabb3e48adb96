from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def doc_rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def run_oracle():
    def run(sql: str, sf_dir: str = SMALL):
        con = duckdb.connect()
        for t in "documents embeddings pages benchmark labels conversations".split():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        rel = con.sql(sql)
        columns = rel.columns
        return columns, rel.fetchall()

    return run


#: Awkward rows: nulls, empties, ties, repeated rows, one long text, a clashing column.
AWKWARD = [
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (3, None),
    (4, ""),
    (5, "  \t\n "),
    (None, "one two three four five six seven"),
    (None, None),
    (6, "short"),
    (7, "wörd " * 20000),
    (8, "A line that is long enough to be counted as a line, surely.\nother"),
    (9, "  a LINE that is long enough to be counted as a line, surely.\t\nmore"),
    (10, "a line that is long enough to be counted as a line, surely.\n\n"),
    (11, "x\na line that is long enough to be counted as a line, surely."),
    (12, "a line that is long enough to be counted as a line, surely."),
    (None, "a line that is long enough to be counted as a line, surely.\nend"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(d, t, "en", f"s{i}", 7, 8) for i, (d, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_lines int, component_id int"
    )
