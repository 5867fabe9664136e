"""Small inputs and plain-Python counterparts that the tests of this folder share."""

from __future__ import annotations

import os

import duckdb

SMALL = "/root/testdata/sf0.001"

# Names that the operators use inside stand here for columns of the user's.
SCHEMA = (
    "doc_id long, text string, source string, lang string, n_chars long, "
    "line string, name string, size long, key string, copies long, spread string, bucket int"
)


def documents(spark, rows):
    """(doc_id, text[, source[, lang]]) tuples as a table with clashing extra columns."""
    full = [
        (*row, *[None] * (4 - len(row)), 7, "x", "x", 7, "x", 7, "x", 7) for row in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def collected(df, *columns):
    return sorted(
        (tuple(row[c] for c in columns) for row in df.select(*columns).collect()), key=repr
    )


def shingle_set(text, width=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def oracle(sf_dir=SMALL):
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        path = f"{sf_dir}/{name}.parquet"
        path = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection
