"""Line dedup by pairwise alignment of overlapping documents.

1. Every document becomes the hashes and word counts of its lines (trimmed; a narrow table).
2. Overlapping pairs come from shared line hashes. A rare line (in at most ``RARE``
   documents) pairs each of its documents with every earlier one. Frequent lines need no
   cap: for every line a document also has the hash of the shortest run of lines from it,
   forwards and backwards, that holds ``MIN_WORDS`` words, and such a run pairs each of its
   documents with the first one that has it. A block that can be deleted holds at least
   ``MIN_WORDS`` words, so each of its lines lies in such a run.
3. Each pair is aligned by patience diff on the line hashes, and aligned blocks of at least
   ``MIN_WORDS`` words are marked in the later document.
   A run that a document has in common with an earlier one need not be aligned there. While
   a run still has unmarked lines in some document, that document is paired with the run's
   next holders, ``GROWTH`` times as many in every round, until all its lines are marked or
   all earlier holders are looked at: some log4 of the holders' number. Documents of the same lines in the same order
   are aligned alike, so only the first of them counts as a holder. So the marks are those
   of all pairs, and the number of pairs does not grow with the square of a group of copies.
4. A document loses the lines marked by any of its pairs. The first document with a line
   has no earlier one, so at least one copy of every line stays.

"Later" goes by doc_id, then by a hash of the text; null ids come last.

Defined cases: a null or empty text has no lines to compare and is returned as it is; rows
equal in id and text are one document and get the same result; ties as above; a document
whose every line goes becomes an empty text; empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from xxhash import xxh64_intdigest

from omnitally.llm.common import documents, materialize

RARE, MIN_WORDS = 4, 50
#: Further holders of a run that a round looks at: at first, and at most.
HOLDERS, GROWTH = 4, 4
NULL_ID = (1 << 63) - 1
_LONGS = T.ArrayType(T.LongType())
_LINES = T.StructType([T.StructField("hashes", _LONGS), T.StructField("words", T.ArrayType(T.IntegerType())),
                       T.StructField("runs", _LONGS)])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _run_spans(words: list[int], least: int) -> list[tuple[int, int]]:
    """The shortest runs of ``least`` words from each line on, and up to each line."""
    spans, end, held = [], 0, 0
    for start in range(len(words)):
        while end < len(words) and held < least:
            held += words[end]
            end += 1
        if held < least:
            break
        spans.append((start, end))
        held -= words[start]
    # Backwards: among the runs up to a line, the one that starts last.
    start, held = 0, 0
    for end in range(1, len(words) + 1):
        held += words[end - 1]
        while held - words[start] >= least:
            held -= words[start]
            start += 1
        if held >= least:
            spans.append((start, end))
    return spans


def _run_hashes(hashes: list[int], spans: list[tuple[int, int]]) -> list[int]:
    return sorted({_signed(xxh64_intdigest(",".join(map(str, hashes[a:b])))) for a, b in spans})


def lines_of(text: str | None, least: int = MIN_WORDS) -> tuple[list[int], list[int], list[int]]:
    """Hash and word count of every line, and the run hashes."""
    if not text:
        return [], [], []
    lines = [x.strip().encode("utf-8", "surrogatepass") for x in text.split("\n")]
    hashes = [_signed(xxh64_intdigest(x)) for x in lines]
    words = [len(x.split()) for x in lines]
    return hashes, words, _run_hashes(hashes, _run_spans(words, least))


def open_runs(hashes: list[int], words: list[int], marked: list[int], least: int = MIN_WORDS) -> list[int]:
    """Hashes of the runs with a line that is not marked."""
    left = [1] * len(hashes)
    for i in marked:
        left[i] = 0
    left = [0, *accumulate(left)]
    return _run_hashes(hashes, [(a, b) for a, b in _run_spans(words, least) if left[a] < left[b]])


def _lines(text: Column, least: int) -> Column:
    @F.pandas_udf(_LINES)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([lines_of(t, least) for t in texts], columns=_LINES.names)
    return run(text)


def patience(a: list[int], b: list[int], words: list[int] | None = None, least: int = 1) -> list[tuple[int, int]]:
    """Aligned positions of two sequences by patience diff, ascending in both.

    Where no line is unique, the block in common with most words (of ``b``; by default each
    line counts as one) is aligned, if it has ``least`` of them.
    """
    sums = [0, *accumulate([1] * len(b) if words is None else words)]
    out, stack = [], [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = _unique_common(a, a0, a1, b, b0, b1)
        if not anchors:
            anchors = _heaviest_block(a, a0, a1, b, b0, b1, sums, least)
            if not anchors:
                continue
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        out += anchors
        stack += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def _heaviest_block(a, a0, a1, b, b0, b1, sums, least) -> list[tuple[int, int]]:
    """The block of consecutive lines in common with most words, none if that is under ``least``.

    Equal lines at the range's borders are aligned already, so a lighter block cannot be
    part of one that is deleted. Found with a suffix automaton in time linear in the range.
    """
    common = set(a[a0:a1]).intersection(b[b0:b1])
    if sum(sums[j + 1] - sums[j] for j in range(b0, b1) if b[j] in common) < least:
        return []
    step, link, size, end, last = [{}], [-1], [0], [a0 - 1], 0
    for i in range(a0, a1):
        new, at = len(step), last
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        end.append(i)
        while at >= 0 and a[i] not in step[at]:
            step[at][a[i]] = new
            at = link[at]
        if at >= 0:
            to = step[at][a[i]]
            if size[to] > size[at] + 1:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                size.append(size[at] + 1)
                end.append(end[to])
                link[to], old, to = copy, to, copy
                while at >= 0 and step[at].get(a[i]) == old:
                    step[at][a[i]] = copy
                    at = link[at]
            link[new] = to
        last = new
    best, at, n = (0, 0), 0, 0
    for j in range(b0, b1):
        while at and b[j] not in step[at]:
            at = link[at]
            n = size[at]
        if b[j] in step[at]:
            at, n = step[at][b[j]], n + 1
        found = sums[j + 1] - sums[j + 1 - n], n
        if found > best:
            best, last = found, (end[at], j)
    if best[1] == 0 or best[0] < least:
        return []
    return [(last[0] - k, last[1] - k) for k in reversed(range(best[1]))]


def _unique_common(a, a0, a1, b, b0, b1) -> list[tuple[int, int]]:
    """The longest ascending chain of lines that occur once in either range."""
    def once(x, lo, hi):
        seen = {}
        for i in range(lo, hi):
            seen[x[i]] = -1 if x[i] in seen else i
        return seen
    of_b = once(b, b0, b1)
    pairs = [(i, of_b[h]) for h, i in once(a, a0, a1).items() if i >= 0 and of_b.get(h, -1) >= 0]
    pairs.sort()
    tops, chain = [], []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left([pairs[t][1] for t in tops], j) if len(tops) < 32 else _place(pairs, tops, j)
        chain.append(tops[k - 1] if k else -1)
        tops[k:k + 1] = [n]
    out, n = [], tops[-1] if tops else -1
    while n >= 0:
        out.append(pairs[n])
        n = chain[n]
    return out[::-1]


def _place(pairs, tops, j) -> int:
    low, high = 0, len(tops)
    while low < high:
        mid = (low + high) // 2
        if pairs[tops[mid]][1] < j:
            low = mid + 1
        else:
            high = mid
    return low


def common_blocks(earlier: list[int], later: list[int], words: list[int], least: int = MIN_WORDS) -> list[int]:
    """Line numbers of ``later`` that lie in aligned blocks of at least ``least`` words."""
    out, block, size, last = [], [], 0, None
    for i, j in [*patience(earlier, later, words, least), (-9, -9)]:
        if last != (i - 1, j - 1):
            if size >= least:
                out += block
            block, size = [], 0
        block.append(j)
        size += words[j] if j >= 0 else 0
        last = (i, j)
    return out


def _marks(least: int):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(earlier: pd.Series, later: pd.Series, words: pd.Series) -> pd.Series:
        return pd.Series([common_blocks(a.tolist(), b.tolist(), w.tolist(), least)
                          for a, b, w in zip(earlier, later, words)])
    return run


def _open_runs(least: int):
    @F.pandas_udf(_LONGS)
    def run(hashes: pd.Series, words: pd.Series, marked: pd.Series) -> pd.Series:
        return pd.Series([open_runs(h.tolist(), w.tolist(), [] if m is None else m.tolist(), least)
                          for h, w, m in zip(hashes, words, marked)])
    return run


def _rare_pairs(lines: DataFrame, rare: int) -> DataFrame:
    """(later, earlier): documents that share a rare line."""
    body = F.filter(F.arrays_zip("hashes", "words"), lambda x: x["words"] > 0)
    seeds = lines.select("doc", F.explode(F.array_distinct(F.transform(body, lambda x: x["hashes"]))).alias("h"))
    # Counts and minima are combined before they are shuffled; the joins that follow hand
    # their rows on, so that a frequent line's rows can be split over tasks.
    few = seeds.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n").between(2, rare)).select("h")
    few = materialize(seeds.join(few, "h"), "rare-lines")
    both = few.select("h", F.col("doc").alias("later")).join(few.select("h", F.col("doc").alias("earlier")), "h")
    return both.select("later", "earlier").where("later > earlier")


def _marked(lines: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """(later, line): the lines that the pairs' alignments mark."""
    body = lines.select("doc", "hashes", "words")
    joined = (pairs.join(body.select(F.col("doc").alias("earlier"), F.col("hashes").alias("before")), "earlier")
              .join(body.select(F.col("doc").alias("later"), "hashes", "words"), "later"))
    return joined.select("later", F.explode(_marks(least)("before", "hashes", "words")).alias("line")).distinct()


def _by_document(marked: DataFrame) -> DataFrame:
    return marked.groupBy("later").agg(F.array_sort(F.collect_list("line")).alias("deleted")).select(
        F.col("later").alias("doc"), "deleted")


def _all_marks(lines: DataFrame, rare: int, least: int) -> DataFrame:
    """(doc, deleted): the lines that an alignment with any earlier document marks."""
    runs = lines.select("doc", F.explode("runs").alias("h"))
    first = materialize(runs.groupBy("h").agg(F.count("*").alias("n"), F.min("doc").alias("earlier")).where("n > 1"), "first-holders")
    frequent = runs.select("h", F.col("doc").alias("later")).join(first, "h").select("later", "earlier")
    pairs = materialize(_rare_pairs(lines, rare).union(frequent.where("later > earlier")).distinct(), "line-pairs")
    marked = materialize(_marked(lines, pairs, least), "line-marks")
    seen, more, holders = first.where("n > 2").select("h", F.col("earlier").alias("seen")), HOLDERS, None
    todo = runs.join(seen, "h").where(F.col("doc") > F.col("seen")).select("doc", "h")
    while True:
        # Runs with unmarked lines, and the run's holders that no round has looked at yet.
        docs = todo.select("doc").distinct()
        unmarked = (lines.select("doc", "hashes", "words").join(docs, "doc").join(_by_document(marked).hint("merge"), "doc", "left")
                    .select("doc", F.explode(_open_runs(least)("hashes", "words", "deleted")).alias("h")))
        todo = materialize(todo.join(unmarked, ["doc", "h"], "left_semi"), "open-runs")
        if todo.isEmpty():
            return _by_document(marked)
        if holders is None:
            alike = lines.groupBy(F.xxhash64("hashes")).agg(F.min("doc").alias("doc")).select("doc")
            holders = materialize(runs.join(alike, "doc", "left_semi"), "run-holders")
        wanted = todo.groupBy("h").agg(F.max("doc").alias("last"))
        held = holders.join(seen.join(wanted, "h"), "h").where((F.col("doc") > F.col("seen")) & (F.col("doc") < F.col("last")))
        rank = F.row_number().over(Window.partitionBy("h").orderBy("doc"))
        held = materialize(held.select("h", "doc").withColumn("rank", rank).where(F.col("rank") <= more)
                           .select("h", F.col("doc").alias("earlier")), "next-holders")
        new = (todo.withColumnRenamed("doc", "later").join(held, "h").where("later > earlier").select("later", "earlier")
               .distinct().join(pairs, ["later", "earlier"], "left_anti"))
        new = materialize(new, "line-pairs")
        pairs = materialize(pairs.union(new), "line-pairs")
        marked = materialize(marked.union(_marked(lines, new, least)).distinct(), "line-marks")
        # A run without a further holder is dropped here, with its rows.
        seen = materialize(held.groupBy("h").agg(F.max("earlier").alias("seen")), "last-holders")
        todo = todo.join(seen, "h").where(F.col("doc") > F.col("seen")).select("doc", "h")
        more *= GROWTH


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rare: int = RARE,
                least: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without the deleted lines, n_lines, deleted (line numbers, ascending)."""
    doc = F.struct(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("i"),
                   F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    rows = docs.select(doc.alias("doc"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    lines = rows.select("doc", _lines(F.col("text"), least).alias("x")).select("doc", "x.*").where(F.size("hashes") > 0)
    lines = materialize(lines, "lines").dropDuplicates(["doc"])
    marked = materialize(_all_marks(lines, rare, least), "line-marks")
    # The marks grow with the corpus, so they are never broadcast.
    out = rows.join(marked.hint("merge"), "doc", "left").withColumn("deleted", F.coalesce("deleted", F.array().cast("array<int>")))
    return out.withColumn("parts", F.split(F.coalesce("text", F.lit("")), "\n")).select(
        "doc_id",
        F.when(F.size("deleted") == 0, F.col("text")).otherwise(_without(F.col("parts"), F.col("deleted"))).alias("text"),
        F.size("parts").alias("n_lines"), "deleted")


def _without(parts: Column, deleted: Column) -> Column:
    gone = F.map_from_arrays(deleted, deleted)
    kept = F.filter(F.arrays_zip(parts.alias("l"), F.sequence(F.lit(0), F.size(parts) - 1).alias("n")),
                    lambda x: ~F.map_contains_key(gone, x["n"]))
    return F.array_join(F.transform(kept, lambda x: x["l"]), "\n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the blocks that an earlier one has, and the lines deleted."""
    out = deduplicate(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"),
                      F.size("deleted").cast("long").alias("n_deleted"),
                      F.array_join("deleted", ",").alias("deleted"), "text")
