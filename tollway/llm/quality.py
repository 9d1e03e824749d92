"""Quality rules: a table of thresholds, compiled into one projection of built-in functions.

Nulls: a null text has no words and fails. Texts of any length are judged whole. Repeated rows are judged
alike, an empty table gives an empty result, and extra columns are dropped by ``measure`` and kept by ``keep``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollway.llm.common import BLANKS, blank_words

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had "
    "le la les de des du et un une en que qui dans pour pas sur au avec est par "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "el los las que y en por con una su para es del se lo como más o"
).split()

#: (measure, smallest, largest); None: no bound. A document is kept when all hold.
THRESHOLDS: list[tuple[str, float | None, float | None]] = [
    ("n_words", 50, None),
    ("repeat_ratio", None, 0.5),
    ("mean_word_chars", 2.0, 12.0),
    ("symbol_ratio", None, 0.3),
    ("stop_ratio", 0.05, None),
    ("dup_line_ratio", None, 0.5),
    ("mark_line_ratio", None, 0.9),
]


def ratio(n: str, d: str) -> Column:
    return F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(F.lit(0.0))


#: Ratios of counts, by the names that THRESHOLDS uses.
RATIOS = {
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "stop_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "mark_line_ratio": ("n_mark_lines", "n_lines"),
}


def verdict(thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> Column:
    """The table as one condition on the counted columns."""
    tests = []
    for name, least, most in thresholds:
        value = ratio(*RATIOS[name]) if name in RATIOS else F.col(name)
        tests += [value >= least] if least is not None else []
        tests += [value <= most] if most is not None else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def count(df: DataFrame) -> DataFrame:
    """df with the counted columns. Windows of three words are told apart by a 64-bit hash within one document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = df.withColumns({"_words": blank_words(F.col("text")), "_lines": F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")})
    w = F.col("_words")
    windows = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_h", windows)
    h = F.col("_h")
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    df = df.withColumn("_s", F.when(repeats, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    same = lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | ((k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == x["h"]))
    at = F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))
    step = lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + F.least(F.lit(3), i + 3 - a["end"])).alias("n"))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"])
    strip = lambda chars: F.translate(text, chars, "")
    stop = [x for x in dict.fromkeys(STOP_WORDS)]
    marks = F.filter(F.col("_lines"), lambda x: F.trim(x, F.lit(BLANKS)).rlike("^[-*•]|(\\.\\.\\.|…)$"))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(strip(BLANKS)).cast("long"),
        "n_symbols": (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_mark_lines": F.size(marks).cast("long"),
        "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    })
    return df.drop("_words", "_lines", "_h", "_s")


def judge(df: DataFrame, thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """df with the counts, base_failed and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return count(df).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(thresholds))


def measure(docs: DataFrame, thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept."""
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(docs.select("doc_id", "text"), thresholds).select(*first, "n_lines", "n_mark_lines", "n_stop_words")


def keep(docs: DataFrame, thresholds: list[tuple[str, float | None, float | None]] = THRESHOLDS) -> DataFrame:
    """The documents that pass, with their own columns. The text is judged under a name of its own, so that no column clashes."""
    row = docs.select(F.struct("*").alias("_row"), F.col("text"))
    # the row number keeps the optimizer from moving the test below the counts, where it would repeat each of them
    tested = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judge(row, thresholds).withColumn("_keep", tested).where("_keep").select("_row.*")
