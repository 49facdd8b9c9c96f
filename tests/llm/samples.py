"""Rows that every operator must take: missing values, repeats, ties, long texts, clashing columns."""

from __future__ import annotations

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size int, key string, shard string, slot string, row string, n int, fp string, label string, "
    "words string, lines string, score string, hi int, source_no int, offset int, count string"
)
LONG = "Alpha beta gamma delta. " * 20_000 + "\nlast line of the long text"
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nshared line of text\nx", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today.\n  SHARED line of text\t\nx", "en", "a"),
    (3, "", "en", "b"),
    (4, None, None, "b"),
    (5, "  \n\t\n", None, None),
    (6, LONG, "en", "c"),
    (7, "Ähnliche Wörter über Öl und Straßen.\nshared line of text", "de", None),
    (None, "a text without an id\nshared line of text", None, "c"),
    (None, None, None, None),
    (8, "twice the same row\nshared line of text", "en", "a"),
    (8, "twice the same row\nshared line of text", "en", "a"),
    (9, "one id with\ntwo different texts", "en", "b"),
    (9, "another text of the same id, which is longer", "en", "b"),
    (10, "12345 67890 !!! ### 你好 世界 \U0001f600", "zh", "b"),
]


def edge_docs(spark):
    rest = ("x", "k", "s", "t", "r", 1, "f", "l", "w", "li", "sc", 2, 3, 4, "co")
    rows = [(i, t, la, s, len(t or ""), 7, *rest[1:6], *rest[6:]) for i, t, la, s in TEXTS]
    return spark.createDataFrame(rows, COLUMNS)


def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


def table_dir(spark, tmp_path, docs, **tables) -> str:
    """A folder with the documents and other tables, as queries read it."""
    for name, frame in {"documents": docs, **tables}.items():
        frame.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def texts_of(sf_dir: str, table: str = "documents") -> list[dict]:
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()
