from pyspark.sql import functions as F

from tallyhouse.operators.wordcount import document_word_count, line_tokens, word_count


def test_line_tokens(spark):
    df = spark.createDataFrame([("a b  ",), ("  a",), ("",), ("   ",)], "line string")
    got = [r[0] for r in df.select(line_tokens(F.col("line"))).collect()]
    assert got == [["a", "b"], ["", "", "a"], [""], []]


def test_word_count_golden(spark):
    lines = spark.createDataFrame([("hello scala",), ("java hadoop",), ("hadoop demo",)], "value string")
    got = {r.word: r["count"] for r in word_count(lines).collect()}
    assert got == {"scala": 1, "hello": 1, "java": 1, "hadoop": 2, "demo": 1}


def test_document_lines(spark):
    docs = spark.createDataFrame([("x y\n\ny\n",), ("",), (None,), ("z\r\nz",)], "text string")
    got = {r.word: r["count"] for r in document_word_count(docs).collect()}
    assert got == {"x": 1, "y": 2, "": 1, "z": 2}
