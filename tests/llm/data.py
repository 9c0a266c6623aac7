"""Small tables with the cases that every operator has to bear."""

from __future__ import annotations

import os

import duckdb

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, fp string, id string, label string, host string, n int"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns that clash."""
    long = " ".join(f"word{i % 977}" for i in range(150_000))
    same = "the cat sat on the mat and the dog ran off to the sea"
    texts = [(1, same), (2, same), (2, same), (3, None), (4, ""), (5, " \n\t "), (6, long), (None, same + " again"), (None, None), (7, "12 34"), (8, "!!! ???"), (9, "été Été ßtraße 漢字 😀")]
    rows = [(i, t, "en" if t and "the" in t else None, None if i == 3 else "s", None, "x", "y", "z", "l", "h", 1) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def oracle(sql: str, folder: str = SMALL):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet{'/*.parquet' if os.path.isdir(f'{folder}/{name}.parquet') else ''}')")
    return con.execute(sql).df()


def write_tables(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
