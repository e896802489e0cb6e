"""Personal data: patterns propose, checksums confirm, nearby words adjust the score. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.llm.content import UPPER, ascii_lower
from sward.llm.spans import find_spans

#: Possessive and anchored forms of the plain patterns: they match the same texts without recursion or retries inside a
#: run, so a text of a million equal characters costs linear time and no stack. ``\G`` is where the last match ended.
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0),
    "card": (r"[0-9](?:[\x20-]?[0-9]){15,}+", 0),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+)(?![A-Za-z0-9])", 0),
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: A byte of an address, with leading zeros.
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Score before context, and words nearby that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT = {
    "email": "mail|contact|write|address",
    "ip": "address|host|server|login|client",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|contact",
    "iban": "iban|bank|account|konto|compte|cuenta",
}
#: Words nearby that lower it: the number is more likely an example, a version or an order number.
AGAINST = "example|version|order|invoice|test|sample"
STEP = 0.1


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    at = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.when(F.length(digits) > 0, F.aggregate(F.transform(at, value), F.lit(0), lambda a, b: a + b) % 10 == 0).otherwise(False)


def mod97(code: Column) -> Column:
    """Whether an IBAN without spaces has remainder 1: country and check digits go last, letters become 10 to 35."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit(UPPER), c)
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def valid(kind: Column, found: Column) -> Column:
    """The validators; a proposal that fails is dropped, nothing shorter is tried."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    return (
        F.when(kind == "ip", found.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$"))
        .when(kind == "card", F.length(digits).between(16, 19) & luhn(digits))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .when(kind == "iban", mod97(F.regexp_replace(found, " ", "")))
        .otherwise(True)
    )


def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.0) -> DataFrame:
    """``(key, spans)`` for every row; ``spans`` is an array of ``(rank, start, end, kind, score)`` by kind, then start.

    Null texts are empty. Repeated rows and null keys are kept, each with its own spans; other columns are not read; no
    rows give no rows. Scores never remove a span unless ``least`` asks for it. Context is the text between neighbouring
    proposals of a kind, at most 48 characters on either side.

    Rows carry a number of their own through the one shuffle, which holds matches and their context, not texts.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), whole.alias("text"), F.monotonically_increasing_id().alias("row"))
    found = find_spans(rows, PATTERNS, ("row", "key"), every_row=True)
    near = ascii_lower(F.concat_ws(" ", "before", "after"))
    prior = F.create_map(*[F.lit(x) for k, v in PRIOR.items() for x in (k, v)])
    raised = F.lit(0.0)
    for kind, words in CONTEXT.items():
        raised = F.when((F.col("kind") == kind) & near.rlike(words), STEP).otherwise(raised)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), prior[F.col("kind")] + raised - F.when(near.rlike(AGAINST), 2 * STEP).otherwise(0.0)))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(PATTERNS) for x in (k, i)])
    confirmed = F.col("kind").isNotNull() & valid(F.col("kind"), F.col("found")) & (score >= least)
    span = F.when(confirmed, F.struct(rank[F.col("kind")].alias("rank"), "start", "end", "kind", F.round(score, 3).alias("score")))
    spans = found.groupBy("row", "key").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    return spans.select(F.col("key").alias(key), "spans")
