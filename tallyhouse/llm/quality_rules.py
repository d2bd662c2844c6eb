"""Quality rules with thresholds that adapt to each language and source.

Everything is DataFrame functions.  Per document the base counts are taken over
the whole text (`base_metrics`).  Five rates, as whole numbers, go into mergeable
quantile sketches: a sketch is a table of bucket counts, a bucket being a value
cut to its leading ``SKETCH_BITS`` bits, so a quantile read from it is off by less
than 2 ** (1 - SKETCH_BITS) of its value.  Partition sketches merge by adding
counts, in any order and with the same result, so recomputed tasks and merged
groups agree: a (lang, source) group with fewer than ``LEAST_ROWS`` sketched rows
takes the merged sketch of its language, and a language with fewer the merged
sketch of all.  Only documents that pass the base rule are sketched.

A threshold is a fence around the quartiles: below ``q1 - spread`` or above
``q3 + spread`` with ``spread = FENCE * max(q3 - q1, least)``, where ``least`` keeps
groups of almost equal values from rejecting ordinary rows.  Thresholds are joined
to the documents and filter them.

A null text has no words; a null lang or source is a group of its own; a document
without words has all counts 0 and fails the base rule.  Repeated rows count
as often as they occur.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import fresh_name, read_input, saved

SKETCH_BITS = 8
LEAST_ROWS = 40
FENCE = 6
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\x0b\x0c\r "
# rate: (SQL over the base counts, least quartile distance, which sides are fenced)
RATES = {
    "word_length": ("(1000 * word_chars) DIV n_words", 400, "both"),
    "symbol_rate": ("(1000000 * n_symbols) DIV word_chars", 2000, "above"),
    "dup_line_rate": ("(1000000 * n_dup_lines) DIV (1 + n_lines)", 70000, "above"),
    "repeat_rate": ("(1000000 * n_repeat_words) DIV n_words", 60000, "above"),
    "upper_rate": ("(1000000 * n_upper) DIV word_chars", 20000, "above"),
}


def base_metrics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, n_upper added.

    Repeated words: the 3-word windows are numbered and sorted by hash, those
    equal to a neighbour are kept, and in order of place each covers the words up
    to the next one's first, at most three.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    words = F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    w, line, win, dup = (fresh_name(df, n) for n in ("words_", "lines_", "windows_", "repeats_"))
    out = df.withColumn(w, words).withColumn(line, lines)
    windows = F.expr(
        f"""transform(sequence(1, greatest(size(`{w}`) - 2, 0) + 1),
                      i -> struct(xxhash64(get(`{w}`, i - 1), get(`{w}`, i), get(`{w}`, i + 1)) AS h, i AS i))"""
    )
    out = out.withColumn(win, F.sort_array(F.slice(windows, 1, F.greatest(F.size(w) - 2, F.lit(0)))))
    out = out.withColumn(
        dup,
        F.expr(
            f"""sort_array(transform(
                    filter(`{win}`, (x, k) -> coalesce(get(`{win}`, k + 1).h = x.h, false)
                                           OR coalesce(get(`{win}`, k - 1).h = x.h, false)),
                    x -> x.i))"""
        ),
    )
    squeezed = F.translate(text, WHITE, "")
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.size(w).cast("long").alias("n_words"),
        F.length(squeezed).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
        F.size(line).cast("long").alias("n_lines"),
        F.expr(
            f"""aggregate(transform(`{dup}`, (x, k) -> least(coalesce(get(`{dup}`, k + 1) - x, 3), 3)),
                          0L, (a, b) -> a + b)"""
        ).alias("n_repeat_words"),
        F.length(F.regexp_replace(text, "[^A-Z]", "")).cast("long").alias("n_upper"),
    )


def with_rates(df: DataFrame) -> DataFrame:
    """The rates, 0 where there are no words, and whether the base rule fails."""
    rates = {r: F.expr(f"CASE WHEN n_words > 0 THEN {sql} ELSE 0 END") for r, (sql, _, _) in RATES.items()}
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return df.withColumns(rates).withColumn("base_failed", failed)


def bucket(value: str, bits: int = SKETCH_BITS) -> Column:
    """The column's value (not negative) with all but its leading ``bits`` bits cut off."""
    drop = f"greatest(length(bin({value})) - {bits}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {drop}), {drop})")


def sketch(df: DataFrame) -> DataFrame:
    """``lang, source, rate, bucket, n``: the merged sketches of every (lang, source) of the rows that passed."""
    names = ", ".join(f"'{r}', {r}" for r in RATES)
    long = df.where(~F.col("base_failed")).selectExpr(
        "lang", "source", f"stack({len(RATES)}, {names}) AS (rate, value)"
    )
    return (
        long.withColumn("bucket", bucket("value"))
        .groupBy("lang", "source", "rate", "bucket")
        .agg(F.count("*").alias("n"))
    )


def merged(sketches: DataFrame, *group: str) -> DataFrame:
    return sketches.groupBy(*group, "rate", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, *group: str) -> DataFrame:
    """``group.., rate, n, q1, q3`` of every sketch.

    Buckets of one sketch are bounded in number (``2 ** SKETCH_BITS`` a power of
    two), so a sketch is gathered as one small sorted array and read there.
    """
    one = sketches.groupBy(*group, "rate").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("buckets")
    )
    read = """aggregate(buckets, named_struct('seen', 0L, 'at', cast(null AS long)),
                 (a, b) -> named_struct('seen', a.seen + b.n,
                    'at', CASE WHEN a.at IS NULL AND {k} * (a.seen + b.n) >= {j} * n THEN b.bucket ELSE a.at END)).at"""
    return one.select(
        *group, "rate", "n", F.expr(read.format(k=4, j=1)).alias("q1"), F.expr(read.format(k=4, j=3)).alias("q3")
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """One row a (lang, source): ``<rate>_low`` and ``<rate>_high`` (null: not fenced)."""
    own = quartiles(sketches, "lang", "source")
    by_lang = quartiles(merged(sketches, "lang"), "lang").select(
        F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"), F.col("n").alias("l_n"), F.col("q1").alias("l_q1"), F.col("q3").alias("l_q3")
    )
    overall = quartiles(merged(sketches)).select(
        F.col("rate").alias("a_rate"), F.col("q1").alias("a_q1"), F.col("q3").alias("a_q3")
    )
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rate") == F.col("l_rate"))).join(
        overall, F.col("rate") == F.col("a_rate")
    )

    def pick(q: str) -> Column:
        return (
            F.when(F.col("n") >= LEAST_ROWS, F.col(q))
            .when(F.col("l_n") >= LEAST_ROWS, F.col(f"l_{q}"))
            .otherwise(F.col(f"a_{q}"))
        )

    q = joined.select("lang", "source", "rate", pick("q1").alias("q1"), pick("q3").alias("q3"))
    out = []
    for r, (_, least, sides) in RATES.items():
        spread = FENCE * F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        mine = F.col("rate") == r
        if sides == "both":
            out.append(F.max(F.when(mine, F.col("q1") - spread)).alias(f"{r}_low"))
        out.append(F.max(F.when(mine, F.col("q3") + spread)).alias(f"{r}_high"))
    return q.groupBy("lang", "source").agg(*out)


def judge(df: DataFrame, limits: DataFrame) -> DataFrame:
    """``df`` (with rates) and ``kept``: the base rule holds and no rate lies outside its fence."""
    renamed = limits.withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"})
    inside = ~F.col("base_failed")
    for r, (_, _, sides) in RATES.items():
        inside &= F.coalesce(F.col(r) <= F.col(f"{r}_high"), F.lit(True))
        if sides == "both":
            inside &= F.coalesce(F.col(r) >= F.col(f"{r}_low"), F.lit(True))
    joined = df.join(
        renamed, F.col("lang").eqNullSafe(F.col("limit_lang")) & F.col("source").eqNullSafe(F.col("limit_source")), "left"
    )
    return joined.withColumn("kept", inside).drop("limit_lang", "limit_source")


def quality_verdicts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, base counts, rates, base_failed, the fences of its group, kept."""
    lean = df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
    )
    measured = saved(with_rates(base_metrics(lean)).drop("text"), "quality-rates")
    return judge(measured, thresholds(sketch(measured)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_verdicts(read_input(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
