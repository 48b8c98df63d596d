"""Reply trees to conversations, with DataFrame functions only.

1. Iterative self-joins by pointer doubling: every node holds an ancestor and the sum of
   scores up to it; joining the table with itself doubles the distance, so a tree of
   depth d takes log2(d) joins. That gives every leaf its path's length and score.
2. Branches (root-to-leaf paths) of a tree are ranked by mean score; the best ``top`` stay.
3. The same pointer tables, read from the farthest to the nearest, enumerate the nodes of
   the chosen paths.
4. Each chosen path is formatted as one conversation: turn markers, and text in which
   every control string is broken by an escape that can be undone.

Output segments carry a loss flag: the text of assistant turns is under the loss mask.

Defined cases: null texts and roles count as empty; a parent that is missing from its tree
makes its child a root; nodes on a cycle have no root and no path, and are left out; equal
scores rank by length, then by the smaller leaf; a null tree id is a tree of its own; of
rows with the same tree and node the one of the greatest score, parent, role and text
stays (nulls are least); a row without a node id is no node; a null score counts as 0;
empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from omnitally.llm.common import materialize
from omnitally.sources.tables import read

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings (fixed values of common templates): the first character gets an escape behind it.
CONTROL = r"<(?=\|)|\[(?=/?INST\])|<(?=/?s>)|<(?=</?SYS>>)"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Break control strings: ``\\`` becomes ``\\b``, and ``\\.`` follows their first character."""
    return F.regexp_replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b")), CONTROL, "$0\\\\.")


def unescape(text: Column) -> Column:
    """Undo ``escape``: in escaped text every backslash begins one of three pairs."""
    for pair, plain in (("\\.", ""), ("\\n", "\n"), ("\\b", "\\")):
        text = F.replace(text, F.lit(pair), F.lit(plain))
    return text


def escape_role(role: Column) -> Column:
    """A role stands on one line, so its line breaks are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _same_tree(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """One row per (tree, node), as the module's defined cases say."""
    rest = [c for c in ("score", "parent", "role", "text") if c in nodes.columns]
    one = nodes.where("node IS NOT NULL").groupBy("tree", "node").agg(F.max(F.struct(*rest)).alias("v"))
    return one.select("tree", "node", *[F.col("v")[c].alias(c) for c in rest])


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointer tables (tree, node, up) by doubling distance; and the table of finished paths.

    ``nodes`` has tree, node, parent, score; the result has tree, node, hops, total.
    """
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    state = nodes.join(known, _same_tree("tree", "t") & (F.col("parent") == F.col("n")), "left").select(
        "tree", "node", F.col("n").alias("up"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"),
        F.lit(1).cast("long").alias("hops"))
    state = materialize(state, "climb")
    count, jumps = state.count(), []
    while state.where("up IS NOT NULL").limit(1).count() and 1 << len(jumps) <= count:
        jumps.append(state.where("up IS NOT NULL").select("tree", "node", "up"))
        above = state.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"),
                             F.col("total").alias("more"), F.col("hops").alias("further"))
        # Finished rows stand aside, so a round joins only the nodes still on their way.
        joined = state.where("up IS NOT NULL").join(above, _same_tree("tree", "t") & (F.col("up") == F.col("n")), "left")
        state = materialize(joined.select(
            "tree", "node", F.col("next").alias("up"),
            (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
            (F.col("hops") + F.coalesce("further", F.lit(0))).alias("hops")).union(state.where("up IS NULL")), "climb")
    return jumps, state.where("up IS NULL").drop("up")


def paths(nodes: DataFrame, top: int = 1, unique: bool = False) -> DataFrame:
    """tree, rank, score, node, place: the nodes of the best ``top`` branches of each tree.

    ``unique`` says that no (tree, node) occurs twice, which saves the grouping.
    """
    nodes = nodes if unique else materialize(unique_nodes(nodes), "chat-nodes")
    jumps, climbed = _climb(nodes)
    parents = nodes.select(F.col("tree").alias("t"), F.col("parent").alias("p")).where("p IS NOT NULL").distinct()
    leaves = climbed.join(parents, _same_tree("tree", "t") & (F.col("node") == F.col("p")), "left_anti").withColumn("score", F.col("total") / F.col("hops"))
    order = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("hops").desc(), F.col("node"))
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    marked = chosen.select("tree", "rank", "score", "node")
    for jump in reversed(jumps):
        far = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        marked = marked.join(far, _same_tree("tree", "t") & (F.col("node") == F.col("n")), "left").select(
            "tree", "rank", "score", F.explode(F.array_compact(F.array("node", "up"))).alias("node"))
    places = climbed.select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("hops").alias("place"))
    return marked.join(places, _same_tree("tree", "t") & (F.col("node") == F.col("n"))).drop("t", "n")


def format_paths(nodes: DataFrame, top: int = 1, unique: bool = False) -> DataFrame:
    """tree, rank, score, formatted, segments (text, loss) for ``nodes``
    (tree, node, parent, score, role, text); ``unique`` as in ``paths``."""
    nodes = materialize(nodes if unique else unique_nodes(nodes), "chat-nodes")
    found = paths(nodes.select("tree", "node", "parent", "score"), top, unique=True)
    texts = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    turns = found.join(texts, _same_tree("tree", "t") & (F.col("node") == F.col("n"))).select(
        "tree", "rank", "score",
        F.struct("place", F.array(
            F.struct(F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(F.col("text")).alias("text"), F.coalesce(F.col("role") == LOSS_ROLE, F.lit(False)).alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss"))).alias("parts")).alias("turn"))
    held = turns.groupBy("tree", "rank", "score").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    out = held.withColumn("segments", F.flatten(F.transform("turns", lambda t: t["parts"])))
    return out.select("tree", "rank", "score", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                      "segments")


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    blocks = F.split(formatted, START.replace("|", "\\|"))
    bodies = F.transform(F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))),
                         lambda b: F.substring_index(b, END, 1))
    return F.transform(bodies, lambda b: F.struct(
        unescape(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text")))


def reply_nodes(rows: DataFrame) -> DataFrame:
    """Conversations as reply trees: each row, in turn order, answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"),
                       F.row_number().over(order).alias("node"), "role", "text").select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.length(F.coalesce("text", F.lit(""))).alias("score"), "role", "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and its turns and loss text read back."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    stored = materialize(format_paths(reply_nodes(rows), unique=True).select("tree", "formatted", "segments"), "chats")
    back = stored.select(
        F.expr("try_cast(tree AS BIGINT)").alias("conv_id"), F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       "formatted_chars")


#: Turns and loss text straight from the table; the template's markers and escapes count for formatted_chars.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
        length(role) + length(text) + 24 + length(role || text) - length(replace(role || text, '\', ''))
        + length(role) - length(replace(role, chr(10), ''))
        + 2 * (len(regexp_extract_all(role, '<\||\[/?INST\]|</?s>|<</?SYS>>'))
               + len(regexp_extract_all(text, '<\||\[/?INST\]|</?s>|<</?SYS>>'))) AS chars FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id
"""
