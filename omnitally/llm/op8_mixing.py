"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the documents are ordered by that
key, cut into ranges of the key space (as many as the source's rows ask for, so a hot
source is spread over many tasks), and a distributed prefix sum of word counts runs over
them: sums per range, a running total over the ranges, and a running total inside each
range. A source's budget is met exactly: it repeats in full as many epochs as fit, and the
rest is cut at the word where the running total reaches it.

Targets: sources in code point order, a null source last, weigh 3, 1, 2, 3, 1, 2, ... and
share 150 % of all words; a target stops at twice its source's words and the excess goes
to the others by weight until none is above.

Defined cases: a null text has no words and is never taken; a source without words has the
target 0; ties of the key fall to the size, and rows equal in id and text are
interchangeable, each with its own running total; an empty table gives an empty result;
other columns are carried in a struct by ``mixed_rows`` and cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from omnitally.llm.common import WORD, documents, materialize, text_of

SEED = "mix-1"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
ROWS_PER_RANGE = 50_000


def word_count(text: str | Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: str, text: str, source: str, seed: str = SEED) -> Column:
    """64 hash-random hex digits that depend on the row's source, id and text alone."""
    return F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")), F.lit(":"),
                           F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), text_of(text)), 256)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, n, target for ``sizes`` (source, source_size, n): one row per source.

    With sources sorted by cap over weight, a source is capped exactly when its cap is
    below the level that the rest would share; the level of the last uncapped prefix is
    the common one. The table has one row per source, so its windows are small.
    """
    by_source = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.row_number().over(by_source) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (share * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    t = t.withColumn("level", level).withColumn("free", F.col("cap") / F.col("weight") > F.col("level"))
    common = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(Window.partitionBy())
    return (t.withColumn("common", common["level"])
            .withColumn("target", F.least("cap", F.coalesce(F.col("weight") * F.col("common"), F.col("cap"))))
            .select("source", "source_size", "n", "target"))


def plan_mix(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add source_size, target and taken to ``rows`` (source, size, key, ...)."""
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")),
                        "mix-sources")
    plan = targets(sizes, weights, share, most).withColumn("ranges", F.ceil(F.col("n") / ROWS_PER_RANGE))
    plan = materialize(plan.withColumnRenamed("source", "s"), "mix-targets")
    spot = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    held = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "range", F.floor(spot * F.col("ranges")))
    # Prefix sums: per range, over the ranges of a source, inside a range.
    per = held.groupBy("source", "range").agg(F.sum("size").alias("sum"))
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("s"), F.col("range").alias("r"),
                     F.coalesce(F.sum("sum").over(over), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    held = held.join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("inner")))
    return (held.withColumn("taken", (epochs * F.col("size") + part).cast("long"))
            .drop("s", "r", "n", "ranges", "range", "inner", "offset"))


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               **options) -> DataFrame:
    """The mix itself: each document once for every epoch that takes it, all columns kept.

    The one document per source at which the budget ends is cut after its last taken word
    (the words joined by single spaces); its other columns, a length like ``n_chars`` too,
    stay those of the whole document. Documents that the mix takes no word of go.
    """
    # The key covers every column, so rows that differ anywhere are apart.
    whole = F.sha2(F.concat(random_key(doc_id, text, source), F.to_json(F.struct(*[F.col(c) for c in docs.columns]))), 256)
    keys = docs.select(F.col(source).alias("source"), word_count(text).alias("size"), whole.alias("key"))
    plan = plan_mix(materialize(keys, "mix-rows"), **options)
    # Rows of one key are equal in every column: one is kept and carries all their shares.
    shares = (plan.where("taken > 0").groupBy("key", "taken").agg(F.count("*").alias("rows"), F.first("size").alias("size"))
              .groupBy("key").agg(F.first("size").alias("size"), F.collect_list(F.struct("taken", "rows")).alias("takes")))
    held = docs.select(F.struct("*").alias("doc"), whole.alias("key"))
    joined = held.dropDuplicates(["key"]).join(shares, "key")
    each = joined.withColumn("t", F.explode("takes")).withColumn("take", F.col("t.taken"))
    full = F.floor(F.col("take") / F.col("size")).cast("int")
    cut = (F.col("take") % F.col("size")).cast("int")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("doc")[text], F.lit(WORD), F.lit(0)), F.lit(1), cut), " ")
    # An empty share marks a whole copy, a number the words of a cut one.
    copies = F.concat(F.array_repeat(F.lit(-1), full), F.when(cut > 0, F.array(cut)).otherwise(F.array().cast("array<int>")))
    each = each.withColumn("copy", F.explode(copies)).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("t.rows"))))
    return each.select(*[F.when(F.col("copy") < 0, F.col("doc")[c]).otherwise(head).alias(c) if c == text
                         else F.col("doc")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    rows = documents(spark, sf_dir, "doc_id", "source", "text").select(
        "doc_id", "source", word_count("text").alias("size"), random_key("doc_id", "text", "source").alias("key"))
    out = plan_mix(materialize(rows, "mix-rows"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


_WEIGHT = "CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END"

#: Targets by rounds of resharing (the source list is short), takes by a plain running sum.
ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\v\\f\\r]+')), 0)::BIGINT AS size,
         sha256('{SEED}:' || coalesce('s' || source, 'n') || ':' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size) * 2.0::DOUBLE AS cap, ({_WEIGHT})::DOUBLE AS w
      FROM d GROUP BY source),
fill AS (
  SELECT 0 AS round, -1.0::DOUBLE AS level
  UNION ALL
  SELECT round + 1, (SELECT (1.5 * sum(source_size) - coalesce(sum(cap) FILTER (cap <= w * level), 0))
                            / sum(w) FILTER (cap > w * level) FROM s)::DOUBLE
  FROM fill WHERE round < 60),
t AS (SELECT s.*, least(cap, w * (SELECT level FROM fill WHERE round = 60)) AS target FROM s),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size
    + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END::BIGINT AS taken
FROM p
"""
