"""URL filters: a blocked Bloom filter in front of an exact hash join. DataFrame functions only.

A rule is a host and a path. It fits a URL when the URL's host is the rule's or a subdomain of it and the URL's path
starts with the rule's. Every URL therefore has a few canonical forms (host suffix x path prefix) that a rule could
equal; the Bloom filter discards nearly all of them, the exact join decides about the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.llm.content import ascii_lower

#: Bits a listed rule gets in the filter; 16 leave about one false positive in a thousand.
BITS_PER_RULE = 16
BLOCK_WORDS = 4
#: Filter blocks or rules of more bytes than this are joined by shuffling instead of broadcasting.
BROADCAST_BYTES = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to
    ``?``, ``#`` or the end. Both are empty for null and for texts without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical_rules(rules: DataFrame) -> DataFrame:
    """``(rule_host, rule_path, rule, action)`` from columns ``host``, ``path``, ``action``.

    A null path counts as empty; rules without host or action fit nothing and go. Of rules that are listed twice, the
    larger action in code point order (``block`` before ``allow``) stays.
    """
    return (
        rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action")
        .where((F.col("rule_host") != "") & F.col("action").isNotNull())
        .groupBy("rule_host", "rule_path")
        .agg(F.max("action").alias("action"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )


def _with_mask(df: DataFrame, host: str, path: str, blocks: int) -> DataFrame:
    """The block of a canonical form and, for each word of the block, the two bits it sets."""
    df = df.withColumn("block", F.pmod(F.xxhash64(host, path), F.lit(blocks))).withColumn("_h", F.xxhash64(path, F.lit("bits"), host))
    bit = "shiftleft(1L, cast(shiftrightunsigned(_h, {}) & 63 as int))"
    for w in range(BLOCK_WORDS):
        df = df.withColumn(f"m{w}", F.expr(f"{bit.format(12 * w)} | {bit.format(12 * w + 6)}"))
    return df.drop("_h")


def bloom_blocks(rules: DataFrame, blocks: int) -> DataFrame:
    """``(block, w0..w3)``: the filter as a table of 256-bit blocks."""
    marked = _with_mask(rules, "rule_host", "rule_path", blocks)
    return marked.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(BLOCK_WORDS)])


def _sized(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``(key, host, path, rule, verdict)`` for every page; the longest fitting rule decides, else ``default``.

    ``rules`` has ``host``, ``path``, ``action``. Longest counts the whole rule, then its host. Rows, repeated ones too,
    and null keys are kept as they are; null URLs have an empty host and path and get ``default``. Other columns of
    ``pages`` are not read. An empty list of rules gives ``default`` everywhere; no pages give no rows.

    Only distinct (host, path) pairs that pass the filter are shuffled, after combining in the map tasks. Verdicts come
    back by a left join on those pairs, which AQE may broadcast or split where a pair is hot.
    """
    rules = canonical_rules(rules)
    shape = rules.agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length("rule") * 2 + 64).alias("bytes"),
        F.collect_set(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
        F.collect_set(F.length("rule_path")).alias("lengths"),
    ).first()
    host, path = host_and_path(F.col(url))
    pages = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    if not shape["n"]:
        return pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    blocks = max(1, math.ceil(shape["n"] * BITS_PER_RULE / (64 * BLOCK_WORDS)))

    # Canonical forms: as many host labels and path characters as some rule has.
    parts = F.size(F.split("host", r"\.", -1))
    hosts = F.array_compact(F.array(*[F.when(parts >= k, F.substring_index("host", ".", -k)) for k in sorted(shape["labels"])]))
    paths = F.array_compact(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(shape["lengths"])]))
    forms = (
        pages.select("host", "path")
        .where(F.col("host") != "")
        .select("host", "path", F.explode(hosts).alias("form_host"), paths.alias("_paths"))
        .select("host", "path", "form_host", F.explode("_paths").alias("form_path"))
    )
    fits = F.lit(True)
    for w in range(BLOCK_WORDS):
        fits = fits & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
    possible = (
        _with_mask(forms, "form_host", "form_path", blocks)
        .join(_sized(bloom_blocks(rules, blocks), blocks * 40), "block")
        .where(fits)
        .select("host", "path", "form_host", "form_path")
        .distinct()
    )
    exact = possible.join(
        _sized(rules, shape["bytes"]), (F.col("form_host") == F.col("rule_host")) & (F.col("form_path") == F.col("rule_path"))
    )
    order = F.struct(F.length("rule"), F.length("rule_host"))
    verdicts = exact.groupBy(F.col("host").alias("_host"), F.col("path").alias("_path")).agg(F.max_by(F.struct("rule", "action"), order).alias("best"))
    joined = pages.join(verdicts, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
    return joined.select(key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
