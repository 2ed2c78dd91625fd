"""Small tables with every awkward case, and helpers of the tests."""

from __future__ import annotations

import random
import re

import duckdb
import pandas as pd

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; they must not mind them in a table.
CLASHES = "block key slice size digest fp row id sha kept number score lang_pred language letters text_sha256 copies".split()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed: int, n: int, vocabulary: int = 60) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def awkward(repeats: bool = True) -> list[tuple]:
    """Rows of documents: nulls, empty and very long texts, ties, copies and, unless left out, repeated rows and null ids."""
    shared, other = prose(1, 70, 10_000), prose(2, 45, 10_000)
    long = prose(3, 30_000, 5_000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "b", 0),
        (3, " \t\n ", "en", "b", 4),
        (4, "One", "en", "a", 3),
        (5, "One", "en", "a", 3),
        (6, "one two", None, "a", 7),
        (7, f"start {shared} end", "en", None, 9),
        (8, f"{prose(4, 30)} {shared} {prose(5, 30)} {shared}", "de", "c", 9),
        (9, f"{other} {other} {other}", "de", "ß", 9),
        (10, f"{shared}\x85{other}", "fr", "c", 9),
        (11, long, "fr", "c", len(long)),
        (12, f"x {long}", "fr", "c", len(long)),
        (13, "aaaa" * 400, "es", "d", 1600),
        (14, "aaaa" * 400 + "b", "es", "d", 1601),
        (15, "é" * 300 + "�中文 <|endoftext|> ﷽", "es", "d", 320),
        (16, "123 ... 456", "es", "d", 11),
        (-17, prose(6, 400, 20), "en", "a", 5),
        (2**62, prose(6, 400, 20), "en", "a", 5),
    ]
    if repeats:
        rows += [rows[8], rows[8], rows[3], (9, "another text of the same id", "en", "c", 1), (None, "One", "en", "a", 3), (None, prose(7, 90), None, None, 1)]
    return rows


def frame(spark, rows, clash: bool = True):
    docs = spark.createDataFrame(rows, DOCS)
    if clash:
        docs = docs.selectExpr("*", *[f"'{c}' AS {c}" for c in CLASHES])
    return docs


def sql_rows(sql: str, **tables) -> list[tuple]:
    """Rows of DuckDB SQL over pandas tables, columns in the order of their names."""
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table)
    found = con.sql(sql)
    order = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    return sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)


def spark_rows(df) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def pandas_docs(rows) -> pd.DataFrame:
    table = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"])
    return table.astype({"doc_id": "Int64", "n_chars": "Int64"})
