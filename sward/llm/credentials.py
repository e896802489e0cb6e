"""Secret scans over a ledger of content-addressed versions. DataFrame functions only.

Every version of every file is a blob, named by its SHA-256. The ledger records, for each blob and each version of a
rule, what the rule found there. A run scans only the pairs that the ledger lacks and joins findings back to all paths.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.llm.content import addressed, distinct_digests, owned_texts
from sward.llm.spans import find_spans
from sward.session import free_name, materialise

LEDGER = "blob binary, rule string, spans array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` must have ``least`` characters; matches that fail are dropped without retries."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        """Changes with anything that changes what the rule finds."""
        return f"{self.kind}@{hashlib.sha256(f'{self.pattern}|{self.group}|{self.least}'.encode()).hexdigest()[:16]}"


def either_case(word: str) -> str:
    """A pattern for ``word`` with A-Z in either case and nothing else folded."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in word)


NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), f"{either_case('api')}_?{either_case('key')}"])
#: Kinds in the order in which spans with the same start are listed. Runs that are too short can't hold a longer match
#: later on, so the bounded repetitions of `access` and `hex` find what unbounded ones with a length check would.
BASE_RULES = (
    Rule("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def read_ledger(spark: SparkSession, folder: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, rule, spans)`` of the given rule versions; an absent folder is an empty ledger."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.sql("SELECT cast(null AS binary) blob, cast(null AS string) rule, cast(null AS array<struct<kind:string,start:bigint,end:bigint>>) spans LIMIT 0")
    return spark.read.schema(LEDGER).parquet(folder).where(F.col("rule").isin([r.version for r in rules])).dropDuplicates(["blob", "rule"])


def scan_unseen(rows: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Append to the ledger what is missing for the blobs of ``rows`` (``key, text, digest``).

    A pair without findings is recorded too, with an empty array. One append per run, so a run that dies leaves nothing
    half recorded; pairs that two runs record at once are equal and count once.
    """
    spark = rows.sparkSession
    versions = F.array(*[F.struct(F.lit(r.version).alias("rule"), F.lit(r.kind).alias("kind")) for r in rules])
    pairs = distinct_digests(rows).select("digest", "owner", F.inline(versions))
    seen = read_ledger(spark, ledger, rules).select(F.col("blob").alias("digest"), "rule")
    todo = pairs.join(seen, ["digest", "rule"], "left_anti").groupBy("digest").agg(F.min("owner").alias("owner"), F.collect_set("kind").alias("kinds"))
    texts = owned_texts(rows, todo)
    found = find_spans(texts, {r.kind: (r.pattern, r.group) for r in rules}, ("digest",), combine=True)
    long_enough = F.lit(False)
    for r in rules:
        long_enough = long_enough | ((F.col("kind") == r.kind) & (F.length("part") >= r.least))
    spans = (
        found.where(long_enough)
        .groupBy("digest", "kind")
        .agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("spans"))
    )
    record = todo.select("digest", F.explode("kinds").alias("kind")).join(spans, ["digest", "kind"], "left")
    rule = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)])
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    record.select(F.col("digest").alias("blob"), rule[F.col("kind")].alias("rule"), F.coalesce("spans", nothing).alias("spans")).write.mode("append").parquet(ledger)


def ordered(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """Spans by start, then kind in the order of the rules."""
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def scan_documents(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, blob, spans)`` for every row; ``spans`` is an ordered array of ``(kind, start, end)`` in code points.

    Null texts are empty and have no spans; repeated rows and null keys are kept; other columns are not read; no rows
    give no rows. Findings of a blob return to all its paths by a left join on its name, in which AQE splits hot blobs.
    """
    rows = addressed(docs, key, text)
    scan_unseen(rows, ledger, rules)
    found = read_ledger(docs.sparkSession, ledger, rules).where(F.size("spans") > 0)
    findings = found.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    paths = rows.select(F.col("key").alias(key), F.col("digest").alias("blob"))
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return paths.join(findings, "blob", "left").select(key, "blob", F.coalesce(ordered(F.col("spans"), rules), nothing).alias("spans"))


#: Findings of at most so many blobs are broadcast to the texts; with more, both sides are shuffled.
BROADCAST_BLOBS = 200_000


def redact_documents(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind in brackets; all else, null texts too, stays.

    Repeated rows and null keys are kept, columns of any name too; no rows give no rows.
    """
    scan_unseen(addressed(docs, key, text), ledger, rules)
    found = read_ledger(docs.sparkSession, ledger, rules).where(F.size("spans") > 0)
    blob, spans = free_name(docs, "_blob"), free_name(docs, "_spans")
    findings = found.groupBy(F.col("blob").alias(blob)).agg(F.flatten(F.collect_list("spans")).alias(spans))
    findings = materialise(findings.withColumn(spans, ordered(F.col(spans), rules)), "secret-findings")
    findings = F.broadcast(findings) if findings.count() <= BROADCAST_BLOBS else findings
    named = docs.join(findings, F.unhex(F.sha2(F.col(text), 256)) == F.col(blob), "left")
    clean = F.when(F.col(spans).isNull(), F.col(text)).otherwise(redact(F.col(text), F.col(spans)))
    return named.withColumn(text, clean).drop(blob, spans)


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by ``[kind]``; of overlapping spans the first one's name is used."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.concat(text.substr(acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]")))
        gap = gap.when(s["start"] == acc["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], text.substr(acc["at"].cast("int") + 1, F.length(text))))
