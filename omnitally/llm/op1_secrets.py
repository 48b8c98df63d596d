"""Secret scan with multipart credential linking.

A small helper finds the parts of a credential in each whole text: identifiers, secrets
and endpoints, each with its span and its scope (the block of text between blank lines).
Strong kinds (assign, access, hex) are findings by themselves. Weak candidates (a user
name, a short password, an opaque string, an address) are not: an interval join inside
each scope asks which complementary parts lie within ``RADIUS`` code points, from the end
of one part to the start of the next (0 when they overlap). Of the parts that start before
a part, the one that ends last is the nearest, of the others the one that starts first, so
two windows over the parts in order of position, forwards and backwards, answer it:

- a weak secret is reported only near an identifier,
- an identifier only near a secret,
- an endpoint only near both.

The windows hand each part its nearest complement of every role, so linked parts are named
without making the pairs of a scope. They run over the parts alone (texts are not
shuffled), keyed by row and scope.

Defined cases: a null text counts as empty; a text without parts has no findings; repeated
rows each give a row, with the same findings; equal parts of equal rows are one part; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from omnitally.llm.common import documents, spread

RADIUS = 300
#: Kinds in the order of the result; the first three are the strong ones.
KINDS = ("assign", "access", "hex", "ident", "short", "opaque", "endpoint")
STRONG = KINDS[:3]
ROLE = {"assign": "secret", "hex": "secret", "short": "secret", "opaque": "secret",
        "access": "identifier", "ident": "identifier", "endpoint": "endpoint"}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
IDENT = re.compile(r"""\b(?:access_?key_?id|client_?id|key_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?"""
                   r"""[A-Za-z0-9@._-]{3,}""", re.IGNORECASE | re.ASCII)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""\b(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""")
BLANK = re.compile(r"\n[ \t\r]*\n")
_PART = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                      T.StructField("end", T.IntegerType()), T.StructField("scope", T.IntegerType())])


def _opaque(s: str) -> bool:
    """Mixed like a generated key: a digit, a capital and a small letter."""
    return bool(re.search("[0-9]", s) and re.search("[A-Z]", s) and re.search("[a-z]", s))


def parts_of(text: str | None) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, scope) of every part in a text, by start."""
    if not text:
        return []
    assigned = [(m.start(), m.end(), m.end(2) - m.start(2)) for m in ASSIGN.finditer(text)]
    found = [("assign", a, b) for a, b, n in assigned if n >= 12]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    taken = sorted((a, b) for _, a, b in found)
    found += [("short", a, b) for a, b, n in assigned if 6 <= n < 12]
    found += [("ident", *m.span()) for m in IDENT.finditer(text)]
    if "://" in text:
        found += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    starts = [a for a, _ in taken]
    for m in OPAQUE.finditer(text):
        i = bisect_right(starts, m.end() - 1) - 1
        inside = any(b > m.start() for _, b in taken[max(0, i - 2):i + 1])
        if not inside and _opaque(m[0]):
            found.append(("opaque", *m.span()))
    if not found:
        return []
    blanks = [m.start() for m in BLANK.finditer(text)]
    return sorted(((k, a, b, bisect_right(blanks, a)) for k, a, b in found), key=lambda x: x[1:])


@F.pandas_udf(T.ArrayType(_PART))
def _parts(texts: pd.Series) -> pd.Series:
    return pd.Series([parts_of(t) for t in texts])


def _is(role: str, kind: Column) -> Column:
    return kind.isin([k for k in KINDS if ROLE[k] == role])


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """doc_id and findings: array of start, rank of kind, end, kind, identifier, secret, endpoint.

    identifier, secret and endpoint are the starts of the nearest linked parts (null: none),
    for a part's own role its own start.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("t"),
                       F.spark_partition_id().alias("p"), _parts(F.col(text)).alias("parts"))
    each = rows.select("p", "doc_id", "t", F.posexplode_outer("parts").alias("pos", "part")).select(
        "p", "doc_id", "t", "pos", "part.*")
    # One shuffle by row serves the window and the final grouping.
    each = spread(each, F.col("p"), F.col("doc_id"), F.col("t"))
    scope = Window.partitionBy("p", "doc_id", "t", "scope")
    # Both frames only grow, so a scope takes time in proportion to its parts.
    before = scope.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = scope.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    kind = F.col("kind")

    def nearest(role):
        # By gap: of the parts that start before, the one that ends last; of the others, the first.
        own = _is(role, kind)
        a = F.max(F.when(own, F.struct("end", "start"))).over(before)
        b = F.min(F.when(own, F.col("start"))).over(after)
        left = F.when(a.isNotNull(), F.greatest(F.col("start") - a["end"], F.lit(0)))
        right = F.when(b.isNotNull(), F.greatest(b - F.col("end"), F.lit(0)))
        gap = F.least(left, right)
        at = F.when(b.isNull() | (left <= right), a["start"]).otherwise(b)
        return F.when(own, F.col("start")).when(gap <= radius, at)

    each = each.select("p", "doc_id", "t", "pos", "kind", "start", "end",
                       *[nearest(r).alias(r) for r in ("identifier", "secret", "endpoint")])
    has_id, has_secret = F.col("identifier").isNotNull(), F.col("secret").isNotNull()
    linked = (kind.isin(*STRONG) | (kind.isin("short", "opaque") & has_id) | ((kind == "ident") & has_secret)
              | ((kind == "endpoint") & has_id & has_secret))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), kind)
    finding = F.struct("start", rank.alias("rank"), "end", "kind", "identifier", "secret", "endpoint")
    grouped = each.groupBy("p", "doc_id", "t").agg(
        F.array_sort(F.collect_set(F.when(linked, finding))).alias("findings"),
        F.count(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, 1)).alias("rows"))
    return grouped.select("doc_id", "findings", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_")).drop("_")


def spans(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts, digest of the base spans, and all spans."""
    found = secrets(documents(spark, sf_dir, "doc_id", "text"))

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"].isin(*STRONG))
    return found.select("doc_id", *[count(k) for k in STRONG], F.sha2(spans(base), 256).alias("base_sha256"),
                        spans(F.col("findings")).alias("spans"))
