"""Quality rules with adaptive thresholds.

Each document is measured once. The thresholds are not fixed: for every (language, source)
group a mergeable KLL quantile sketch of each rate is built with partial aggregation, and a
document is rejected when a rate lies beyond its group's fence. A sketch of few values is
replaced by the merged sketch of its language, and where that is small too, by the one of the whole
table. The fences, one row per group, are joined back to the documents.

Rates that every text has spread over a range, so their fences come from the middle of the
range: the share of marks (ASCII characters that are neither letters nor space), the share
of ASCII capitals, the word length, and the logarithm of the different words over that of
all words, which repetition lowers. The upper fence is ``q50 + reach * (q60 - q20)``, the
lower one ``q50 - reach * (q80 - q40)``: junk lies outside these quantiles while it is under two fifths of a
group, so it does not move its own fence. Rates that most texts do not have (repeated
lines, repeated word triples) are sketched where they are above zero; their fence is
``q75 + 3 * max(q75 - q25, q25)`` of those. Only a group whose documents are all alike takes the least spread of a rate.

Defined cases: a null text counts as empty; a document with no words fails the base rule;
null languages and sources form groups of their own (null-safe join); repeated rows are
each measured and each returned; an empty table gives an empty result; further columns of
the input, whatever their names, are kept in a struct and cannot clash.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from omnitally.llm.common import documents, materialize

MEASURES = T.StructType([T.StructField(c, T.LongType()) for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks", "n_upper",
    "n_distinct")])
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalpha())
CAPITALS = bytes(range(65, 91))
#: Rates with a fence, the sides of it, and the spread taken where a group has none.
RATES = {"mark_rate": ("high", 0.001), "upper_rate": ("high", 0.001), "word_length": ("both", 0.02),
         "distinct_rate": ("low", 0.005), "dup_line_rate": ("rare", 0.0), "repeat_rate": ("rare", 0.0)}
REACH, RARE_REACH = 10.0, 3.0
#: Values that a sketch must hold to be used without its parent's.
LEAST_GROUP = 100
SKETCH_K = 400
BROADCAST_GROUPS = 20_000


def _repeated_words(words: list[bytes]) -> int:
    """Words covered by a three-word window that occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, covered, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure_text(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * len(MEASURES)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), _repeated_words(words), len(lines),
            len(data) - len(data.translate(None, MARKS)), len(data) - len(data.translate(None, CAPITALS)), len(set(words)))


@F.pandas_udf(MEASURES)
def measures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts],
                        columns=MEASURES.names)


# Evaluated once, where it stands: a filter on the measures would measure every text again,
# in a second Python worker of the task.
measures = measures.asNondeterministic()


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def _rates(q: Column) -> dict[str, Column]:
    # A text without words or lines has no rate: null, as rates are computed before the rules that such a text fails.
    several = F.when(q["n_words"] > 1, F.try_divide(F.log(q["n_distinct"].cast("double")), F.log(q["n_words"].cast("double"))))
    return {"mark_rate": F.try_divide(q["n_marks"], q["word_chars"]),
            "upper_rate": F.try_divide(q["n_upper"], q["word_chars"]),
            "word_length": F.try_divide(q["word_chars"], q["n_words"]),
            "distinct_rate": several,
            "dup_line_rate": F.try_divide(q["n_dup_lines"], q["n_lines"]),
            "repeat_rate": F.try_divide(q["n_repeat_words"], q["n_words"])}


def fences(measured: DataFrame, least_group: int = LEAST_GROUP, reach: float = REACH) -> DataFrame:
    """One row per (lang, source) of ``measured`` (columns lang, source, q): the fences.

    The sketches see the documents that pass the base rule. A sketch of fewer than
    ``least_group`` values gives way to that of its language, or of all.
    """
    passed = ~base_failed(F.col("q"))
    own = {k: passed & (c > 0) if RATES[k][0] == "rare" else passed for k, c in _rates(F.col("q")).items()}
    groups = measured.groupBy("lang", "source").agg(
        *[F.kll_sketch_agg_double(F.when(own[k], c), F.lit(SKETCH_K)).alias(f"own_{k}")
          for k, c in _rates(F.col("q")).items()])
    groups = materialize(groups, "quality-sketches")

    def merged(df, level):
        return df.agg(*[F.kll_merge_agg_double(f"own_{k}").alias(f"{level}_{k}") for k in RATES])

    by_lang = merged(groups.groupBy(F.col("lang").alias("l")), "lang")
    joined = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("l")), "left")
    table = merged(groups.groupBy(), "all").first()  # one row: the sketches of the whole table

    def sketch(k):
        n = {level: F.kll_sketch_get_n_double(F.col(f"{level}_{k}")) for level in ("own", "lang")}
        every = table[f"all_{k}"]
        return F.when(n["own"] >= least_group, F.col(f"own_{k}")).when(n["lang"] >= least_group, F.col(f"lang_{k}")) \
            .otherwise(F.lit(None if every is None else bytes(every)).cast("binary"))

    picked = joined.select("lang", "source", *[sketch(k).alias(k) for k in RATES])

    def bounds(k, sides, least):
        q = {p: F.kll_sketch_get_quantile_double(F.col(k), F.lit(p / 100)) for p in (20, 25, 40, 50, 60, 75, 80)}
        high = low = F.lit(None).cast("double")
        if sides == "rare":
            high = q[75] + RARE_REACH * F.greatest(q[75] - q[25], q[25])
        if sides in ("high", "both"):
            high = q[50] + reach * F.greatest(q[60] - q[20], F.lit(least))
        if sides in ("low", "both"):
            low = q[50] - reach * F.greatest(q[80] - q[40], F.lit(least))
        full = F.kll_sketch_get_n_double(F.col(k)) > 0
        return F.when(full, F.struct(low.alias("low"), high.alias("high"))).alias(k)

    return picked.select("lang", "source", F.struct(*[bounds(k, *r) for k, r in RATES.items()]).alias("fence"))


def judge(measured: DataFrame, fence_table: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to ``measured`` (columns lang, source, q, ...).

    The fence table has one row per group. It is broadcast only when its counted size is
    small; beyond that the join shuffles and adaptive execution splits hot groups.
    """
    fence_table = materialize(fence_table, "quality-fences")
    if fence_table.count() <= BROADCAST_GROUPS:
        fence_table = F.broadcast(fence_table)
    table = fence_table.select(F.col("lang").alias("f_lang"), F.col("source").alias("f_source"), "fence")
    joined = measured.join(table, F.col("lang").eqNullSafe(F.col("f_lang"))
                           & F.col("source").eqNullSafe(F.col("f_source")), "left")
    within = F.lit(True)
    for k, rate in _rates(F.col("q")).items():
        f = F.col("fence")[k]
        within = within & F.coalesce(rate <= f["high"], F.lit(True)) & F.coalesce(rate >= f["low"], F.lit(True))
    failed = base_failed(F.col("q"))
    return (joined.withColumn("base_failed", failed).withColumn("kept", ~failed & within)
            .drop("f_lang", "f_source", "fence"))


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass the base rule and their group's fences, all columns kept.

    The text is measured twice (once for the sketches, once for the verdict), so whole
    documents are never shuffled.
    """
    measured = docs.select(F.struct("*").alias("doc"), F.col(lang).alias("lang"),
                           F.col(source).alias("source"), measures(F.col(text)).alias("q"))
    table = fences(measured.select("lang", "source", "q"))
    return judge(measured, table).where("kept").select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and the adaptive verdict of every document."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    measured = materialize(docs.select("doc_id", "lang", "source", measures("text").alias("q")), "quality")
    out = judge(measured, fences(measured.drop("doc_id")))
    return out.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines",
                      "q.n_repeat_words", "base_failed", "kept")
