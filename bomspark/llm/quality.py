"""Quality rules: a threshold table compiled into one native projection.

Every rule bounds a ratio of two text statistics.  The statistics and verdicts
are Spark expressions over the whole text; no user function, no shuffle.

The repeated-window statistic hashes each word once, hashes every window of
eight word hashes, and sorts the windows only of texts that have an equal
pair; its cost is linear (n log n for those texts) in the text's words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of

WINDOW = 8
#: The characters counted as symbols.
SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of the corpus languages, as written in running text.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "be",
    "der", "die", "und", "das", "den", "von", "zu", "ist", "mit", "des", "ein", "nicht",
    "le", "la", "les", "et", "des", "en", "un", "une", "est", "que", "pour", "dans", "du",
    "el", "los", "las", "de", "y", "por", "con", "para", "se", "una", "del", "su",
)


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str = "one"
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("length", "n_words", low=20),
    Rule("word_length", "word_chars", "n_words", low=2.0, high=20.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("line_length", "n_words", "n_lines", low=2.0),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.3),
)


def compile_rules(rules=RULES) -> dict[str, Column]:
    """Verdict column per rule name, over the statistics' columns."""
    compiled = {}
    for r in rules:
        bottom = F.lit(1.0) if r.denominator == "one" else F.col(r.denominator).cast("double")
        ratio = F.col(r.numerator).cast("double") / F.nullif(bottom, F.lit(0.0))
        tests = [ratio >= F.lit(float(r.low))] if r.low is not None else []
        tests += [ratio <= F.lit(float(r.high))] if r.high is not None else []
        compiled[r.name] = F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(True))
    return compiled


def _repeat_words(h: Column) -> Column:
    """Words covered by windows whose hash occurs more than once: the repeated
    windows' positions in order each add what the last one did not cover."""
    z = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    n = F.size(h)
    none = F.struct(F.lit(None).cast("bigint").alias("x"), F.lit(None).cast("int").alias("i"))
    before = F.concat(F.array(none), F.slice(z, 1, n - 1))
    after = F.slice(z, 2, n - 1)
    sides = F.zip_with(before, after, lambda a, b: F.struct(a["x"].alias("a"), b["x"].alias("b")))
    marked = F.zip_with(z, sides, lambda e, s: F.when(
        F.coalesce(e["x"] == s["a"], F.lit(False)) | F.coalesce(e["x"] == s["b"], F.lit(False)),
        e["i"]))
    at = F.array_sort(F.array_compact(marked))
    start = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(at, start, lambda acc, p: F.struct(
        (acc["total"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("total"),
        p.alias("last")), lambda acc: acc["total"])


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_stop_words", "n_lines")


def with_statistics(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the statistics of ``text`` as long columns."""
    body = F.coalesce(text, F.lit(""))
    df = docs.withColumns({"__words": words_of(text), "__lines": F.filter(
        F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "__symbols": F.size(F.split(body, SYMBOLS, -1)) - 1})
    df = df.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
    own = F.col("__hashes")
    df = df.withColumn("__windows", F.when(
        F.size(own) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(own) - WINDOW),
            lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")))
    h = F.col("__windows")
    return df.withColumns({
        # The partition's number times zero: Catalyst does not copy a column that depends
        # on it, so a filter above (kept, say) never evaluates the statistics again.
        "n_words": (F.size("__words") + F.spark_partition_id() * 0).cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.col("__symbols").cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_stop_words": F.size(F.filter(
            "__words", lambda w: w.isin(*sorted(set(STOP_WORDS))))).cast("long"),
        "n_repeat_words": F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0))
        .otherwise(_repeat_words(h)).cast("long"),
    }).drop("__words", "__lines", "__symbols", "__hashes", "__windows")


def base_failed() -> Column:
    return ((F.col("n_words") < 20)
            | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules=RULES) -> DataFrame:
    """One row per input row: id, the statistics, ``base_failed``, ``kept`` and
    ``failed_rules`` (names, in the table's order).

    A null, empty or blank text has no words and fails.  Rows with null or
    repeated ids are judged one by one.  Empty input gives no rows; other
    columns are ignored."""
    src = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    df = with_statistics(src, F.col("__text"))
    verdicts = compile_rules(rules)
    return df.select(
        F.col("__id").alias(id_col), *STATISTICS, base_failed().alias("base_failed"),
        (~base_failed() & reduce(lambda a, b: a & b, verdicts.values())).alias("kept"),
        F.array_compact(F.array(*[F.when(~ok, F.lit(n)) for n, ok in verdicts.items()]))
        .alias("failed_rules"))


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged.

    A null, empty or blank text has too few words and goes; nulls elsewhere, repeated rows
    and columns of any name stay as they are.  No rows give no rows."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    df = with_statistics(docs.toDF(*names), F.col(names[docs.columns.index(text_col)]))
    verdicts = compile_rules(rules)
    good = ~base_failed() & reduce(lambda a, b: a & b, verdicts.values())
    return df.where(good).select(*names).toDF(*docs.columns)
