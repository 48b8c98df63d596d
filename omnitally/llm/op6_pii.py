"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

DataFrame functions only. For each kind the matches of its pattern and the lengths of the
gaps between them (the split at the same pattern) give every span's position as running
sums. Validators: Luhn for card numbers, mod-97 for IBANs, ranges for addresses, digit
counts for phone numbers. A span's score is the kind's prior, more for a confirmed
checksum, more for a context word within ``NEAR`` characters before or after it, less for a
word that speaks against it. The context is put together from the gaps and matches next to
a span, so the work grows with the matches of a text, not with their square. Base kinds (email, ip, card, phone) are always reported when valid; further kinds
(iban, ssn, short cards) only from ``LEAST`` on.

The patterns find what the plain ones of the contract find: a look-behind starts a run of
characters at its first one (or where the last match ended), and possessive or bounded
repeats keep long runs linear.

Defined cases: a null text counts as empty; texts without matches have no spans; repeated
rows are each returned; overlapping spans of different kinds are each reported; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omnitally.llm.common import documents, running_sums, text_of

NEAR, LEAST = 40, 0.6
#: No match of any kind is shorter (of a phone: +1 2).
SHORTEST = 4
#: Length of a country's IBANs: those of the registry and those in use beside it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}


def _iban() -> str:
    """A country's IBAN ends at its length, whatever follows; other codes take all that follows."""
    rest = r"(?:\x20?[A-Z0-9])"
    each = [f"(?:{c.replace(' ', '|')})[0-9]{{2}}{rest}{{{n - 4}}}+" for n, c in IBAN_LENGTHS.items()]
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    return (r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(each)
            + rf"|(?!{known})[A-Z]{{2}}[0-9]{{2}}{rest}{{11,30}})(?![A-Za-z0-9])")


#: kind: (pattern, a cheap test that every match implies, prior score, words for it, words against it)
KINDS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8,
              "mail|contact|write to", "example|noreply"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|host|server", "version|release|section"),
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){15}", 0.5,
             "card|visa|master|credit|payment", "order|serial|tracking"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobile|fax", "score|offset"),
    "iban": (_iban(), "[A-Z]{2}[0-9]{2}", 0.3,
             "iban|account|bank|transfer", "part no|model"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-", 0.4, "ssn|social security", "order|serial|part no"),
    "short_card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){12}", 0.1,
                   "card|visa|amex|credit|payment", "order|serial|tracking"),
}
BASE = ("email", "ip", "card", "phone")
CONFIRMED, FOR, AGAINST = 0.4, 0.2, -0.2


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of a string pass the Luhn check."""
    figures = F.reverse(F.filter(F.split(_digits(s), ""), lambda c: c != ""))

    def add(i, c):
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    each = F.transform(figures, lambda c, i: add(i, c))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether an IBAN's remainder is 1: first four characters last, letters as 10 to 35."""
    plain = F.replace(s, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    rest = F.aggregate(chars, F.lit(0), lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97)
                       .otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, "\\."), lambda p: p.cast("double") <= 255)
    if kind in ("card", "short_card"):
        return luhn(s)
    if kind == "phone":
        return F.length(_digits(s)).between(8, 15)
    if kind == "iban":
        return mod97(s)
    if kind == "ssn":
        return ~s.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and findings: array of kind, start, end (code points, end exclusive), score."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    none = F.array().cast("array<string>")
    rows = rows.select("*", *[
        F.when(F.contains("text", F.lit(test)) if test == "@" else F.col("text").rlike(test),
               F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none).alias(f"m_{k}")
        for k, (pattern, test, *_) in KINDS.items()])
    def head(s):
        return F.substring(s, 1, NEAR)

    def tail(s):
        return F.substring(s, -NEAR, NEAR)

    # Every gap between matches is read once: its length, and its ends as context.
    rows = rows.select("*", *[
        F.when(F.size(f"m_{k}") > 0, F.transform(F.split("text", pattern, -1), lambda g: F.struct(
            F.length(g).alias("n"), F.lower(head(g)).alias("head"), F.lower(tail(g)).alias("tail")))).alias(f"gaps_{k}")
        for k, (pattern, *_) in KINDS.items()])
    # The end of each gap with its match, and the start of each match with the gap after it.
    rows = rows.select(
        "*", *[F.zip_with(f"m_{k}", f"gaps_{k}", lambda m, g: tail(F.concat(g["tail"], F.lower(m)))).alias(f"to_{k}") for k in KINDS],
        *[F.zip_with(f"m_{k}", F.slice(f"gaps_{k}", F.lit(2), F.size(f"m_{k}")),
                     lambda m, g: head(F.concat(F.lower(m), g["head"]))).alias(f"from_{k}") for k in KINDS])

    def matches(k):
        # Each match with its surroundings, and the way from the end of the match before. A
        # match and its gap have SHORTEST characters or more, so a few neighbours fill NEAR.
        few, gaps = -(-NEAR // SHORTEST), F.col(f"gaps_{k}")

        def one(m, i):
            before = F.concat_ws("", *[F.get(f"to_{k}", i - j) for j in range(few, 0, -1)], F.get(gaps, i)["tail"])
            after = F.concat_ws("", F.get(gaps, i + 1)["head"], *[F.get(f"from_{k}", i + j) for j in range(1, few + 1)])
            return F.struct(m.alias("m"), F.concat_ws(" ", tail(before), head(after)).alias("around"),
                            (F.get(gaps, i)["n"] + F.length(m)).alias("step"))

        return F.transform(f"m_{k}", one)

    rows = rows.select("*", *[F.when(F.size(f"m_{k}") > 0, matches(k)).alias(f"p_{k}") for k in KINDS])
    rows = rows.select("*", *[F.when(F.size(f"m_{k}") > 0, running_sums(F.col(f"p_{k}.step"))).alias(f"e_{k}") for k in KINDS])

    def spans(k):
        _, _, prior, words_for, words_against = KINDS[k]
        sure = CONFIRMED if k in ("card", "iban", "short_card") else 0.0
        pairs = F.filter(F.arrays_zip(F.col(f"p_{k}").alias("p"), F.col(f"e_{k}").alias("e")), lambda p: _valid(k, p["p"]["m"]))

        def span(p):
            around = p["p"]["around"]
            score = F.lit(prior + sure) + F.when(around.rlike(words_for), FOR).otherwise(0.0) + F.when(
                around.rlike(words_against), AGAINST).otherwise(0.0)
            return F.struct(F.lit(k).alias("kind"), (p["e"] - F.length(p["p"]["m"])).alias("start"), p["e"].alias("end"),
                            F.round(F.least(score, F.lit(1.0)), 2).alias("score"))

        found = F.transform(pairs, span)
        if k not in BASE:
            found = F.filter(found, lambda f: f["score"] >= LEAST)
        return F.when(F.size(f"m_{k}") > 0, found).otherwise(
            F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>"))

    return rows.select("doc_id", F.concat(*[spans(k) for k in KINDS]).alias("findings"))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, digest of the base spans, and all spans."""
    found = findings(documents(spark, sf_dir, "doc_id", "text"))

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda f: f["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(F.col("findings")).alias("spans"))
