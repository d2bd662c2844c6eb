"""Small inputs that the training-data tests share."""

import duckdb

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [
    None,
    "",
    " ",
    "  \n\t ",
    "a",
    "the cat",
    "the  cat\nsat  on\n\nthe mat ",
    " leading and trailing ",
    "x" * 3000,
    "ab " * 2000,
    "naïve café Ünïcode — 日本語 \U0001f600 é",
    "<|endoftext|> in a text <s> </s> <0x0A> <unk>",
    "it's we're I'll 'd 's 12345 3.14 a,b.c!? ...",
    "nul\x00 and \x1c separators \x85 and \xa0 spaces",
    "the cat",
    "ÀΣ word finalΣ ﬁ ",
]


def odd_documents(spark, extra="id long, text string, lang string, source string, doc_id long"):
    """Nulls in every column, empty, long and repeated texts, and columns with names the operators use."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "src0", 5 * i % 23) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "no id at all", None, None, None)]
    df = spark.createDataFrame([(r[4], r[1], r[2], r[3]) for r in rows], "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "cast(1 as int) AS n_tokens", "'x' AS shard", "'y' AS `start`", "cast(null as string) AS h")


def documents(columns="doc_id, text", sf=SF):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{sf}/documents.parquet') ORDER BY doc_id").fetchall()


def as_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
