"""Queries of the subpackage over whole tables, with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.llm import alignment, chat, credentials, decontaminate, importance, licences, mixing, ngram_join, personal, quality_net, tokens, turns, urls
from sward.llm.content import LOWER, UPPER
from sward.llm.spans import span_digest
from sward.session import work_path

Build = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Build] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        PLANS[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# 1. URL filters

#: Host, path and action of the listed rules.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def url_rules(spark: SparkSession) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    return spark.sql(f"SELECT * FROM VALUES {values} AS r(host, path, action)")


@query(
    "op1_url_filter",
    f"""
WITH rules(rh, rp, action) AS (VALUES {", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)}),
cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
  FROM cut
),
best AS (
  SELECT n, arg_max(struct_pack(rule := rh || rp, action := action), length(rh || rp)) AS b
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.action, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"), url_rules(spark))


# 2. Token counts


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Starts from an empty cache, so that its rows and its work don't depend on earlier runs."""
    cache = work_path(spark, "token-counts")
    return tokens.count_tokens(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"), cache)


# 3. Chat formatting

TEMPLATE = chat.Template()
PLANTED = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def escaped_length(column: str) -> str:
    """SQL for the length of an escaped text: one character more for each control string in it."""
    return f"length({column}) + len(regexp_extract_all({column}, '{sql(TEMPLATE.pattern)}'))"


def sql(pattern: str) -> str:
    return pattern.replace("'", "''")


@query(
    "op3_chat_format",
    f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{PLANTED}'), (-7, 1, 'assistant', '{PLANTED}')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({sum(map(len, TEMPLATE.markers.values()))} + {escaped_length("role")} + {escaped_length("text")})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""",
)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    values = ", ".join(f"(-7L, {turn}L, '{role}', '{PLANTED}')" for turn, role in enumerate(("user", "assistant")))
    planted = spark.sql(f"SELECT * FROM VALUES {values} AS c(conv_id, turn, role, text)")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    vocabulary = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return chat.read_back(chat.format_chats(rows, *vocabulary), *vocabulary).drop("n_ids", "n_loss_ids")


# 4. Quality classifier


@query("op4_quality_classifier")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality_net.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


# 5. Secret scans


def span_sql(kinds: list[tuple[str, str, str]], source: str = "documents") -> str:
    """CTE ``placed(doc_id, n, kind, rank, found, part, s, e)``: every match of ``(kind, pattern, part)`` with its place."""
    each = " UNION ALL ".join(
        f"SELECT doc_id, n, '{kind}' AS kind, {rank} AS rank, unnest(string_split_regex(text, '{sql(pattern)}')) AS piece, "
        f"unnest(regexp_extract_all(text, '{sql(pattern)}', 0)) AS found, unnest(regexp_extract_all(text, '{sql(pattern)}', {group})) AS part, "
        f"generate_subscripts(string_split_regex(text, '{sql(pattern)}'), 1) AS i FROM whole WHERE regexp_matches(text, '{sql(pattern)}')"
        for rank, (kind, pattern, group) in enumerate(kinds)
    )
    return f"""whole AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM {source}),
each_piece AS ({each}),
placed AS (
  SELECT *, e - length(found) AS s FROM (
    SELECT *, (sum(length(piece) + coalesce(length(found), 0)) OVER (PARTITION BY n, kind ORDER BY i))::BIGINT AS e FROM each_piece
  ) WHERE found IS NOT NULL
)"""


def joined_spans(order: str, where: str = "true") -> str:
    return f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY {order}) FILTER (WHERE {where}), '')"


def number_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


SECRET_SQL = f"""
WITH {span_sql([(r.kind, r.pattern, str(r.group)) for r in credentials.RULES])},
kept AS (SELECT * FROM placed WHERE length(part) >= CASE kind {" ".join(f"WHEN '{r.kind}' THEN {r.least}" for r in credentials.RULES)} END),
base AS (SELECT * FROM kept WHERE kind IN ('assign', 'access', 'hex')),
per AS (
  SELECT n, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS b, count(*) FILTER (WHERE kind = 'hex') AS c,
    {joined_spans("s, rank", "rank < 3")} AS base, {joined_spans("s, rank")} AS spans
  FROM kept GROUP BY n
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM whole LEFT JOIN per USING (n)
"""


@query("op5_secret_scan", SECRET_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Starts from an empty ledger, so that its rows and its work don't depend on earlier runs."""
    found = credentials.scan_documents(table(spark, folder, "documents"), work_path(spark, "secret-ledger"))
    kinds = [r.kind for r in credentials.BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[number_of(k).alias(f"n_{k}") for k in kinds],
        F.sha2(span_digest(base), 256).alias("base_sha256"),
        span_digest(F.col("spans")).alias("spans"),
    )


# 6. Quality rules

_I = importance
_SPACE = r"[\x20\x09-\x0D]"


def word_lists(source: str) -> str:
    """CTEs ``whole(doc_id, n, text)`` and ``words(n, i, w)``: words split at ASCII white space, numbered from 1."""
    return f"""whole AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM {source}),
lists AS (SELECT n, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM whole),
words AS (SELECT n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM lists)"""


QUALITY_SQL = f"""
WITH {word_lists("documents")},
windows AS (
  SELECT n, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g FROM words WINDOW o AS (PARTITION BY n ORDER BY i)
),
again AS (SELECT n, i FROM windows WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY n, g) > 1),
inside AS (SELECT DISTINCT n, i + k AS i FROM again, range(3) AS r(k)),
repeats AS (SELECT n, count(*) AS c FROM inside GROUP BY n),
lines AS (SELECT n, line, count(*) AS c FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM whole) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY n, line),
doubled AS (SELECT n, sum(c - 1)::BIGINT AS c FROM lines GROUP BY n),
base AS (
  SELECT n, doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '{_SPACE}', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(doubled.c, 0) AS n_dup_lines,
    coalesce(repeats.c, 0) AS n_repeat_words, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS capitals
  FROM whole JOIN lists USING (n) LEFT JOIN doubled USING (n) LEFT JOIN repeats USING (n)
),
hashed AS (SELECT n, i, ('0x' || substr(md5(w), 1, 8))::BIGINT AS h FROM words),
grams AS (
  SELECT n, h % {_I.BUCKETS} AS b FROM hashed UNION ALL
  SELECT n, (h * 31 + h2) % {_I.BUCKETS} FROM (SELECT n, h, lead(h) OVER (PARTITION BY n ORDER BY i) AS h2 FROM hashed) WHERE h2 IS NOT NULL
),
trusted AS (
  SELECT n FROM base WHERE 100 * n_symbols <= {_I.TRUSTED_SYMBOLS} * word_chars
    AND 100 * n_repeat_words <= {_I.TRUSTED_REPEATED} * n_words AND n_dup_lines = 0 AND 100 * capitals <= {_I.TRUSTED_CAPITALS} * word_chars
),
counts AS (SELECT b, count(*) AS raw, count(trusted.n) AS target FROM grams LEFT JOIN trusted USING (n) GROUP BY b),
sums AS (SELECT sum(target)::DOUBLE / sum(raw) AS trusted FROM counts),
ratios AS (
  SELECT b, CASE WHEN trusted = 0 THEN 0 ELSE ln((c.target + {_I.PRIOR} * trusted) / ((c.raw + {_I.PRIOR}) * trusted)) END AS r
  FROM counts c, sums s
),
scores AS (SELECT n, avg(r) AS score FROM grams JOIN ratios USING (b) GROUP BY n)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {_I.LEAST_WORDS} OR 100 * n_repeat_words > {_I.MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {_I.LEAST_WORDS} OR 100 * n_repeat_words > {_I.MOST_REPEATED} * n_words) AND coalesce(score, 0) >= {_I.LEAST_SCORE} AS kept
FROM base LEFT JOIN scores USING (n)
"""


@query("op6_quality_rules", QUALITY_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return importance.rate_documents(table(spark, folder, "documents")).drop("score")


# 7. N-gram Jaccard join


@query("op7_ngram_join")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_classes(table(spark, folder, "documents"))


# 8. Mixing


@query("op8_source_mix")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


# 9. Benchmark decontamination

_W = decontaminate.WINDOW
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def alnum_words(table_name: str, key: str) -> str:
    return f"SELECT {key}, row_number() OVER () AS n, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_ALNUM}') AS ws FROM {table_name}"


LEAKS_SQL = f"""
WITH d AS ({alnum_words("documents", "doc_id")}),
items AS ({alnum_words("benchmark", "item_id")}),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[i : i + size - 1], ' ') AS g FROM (
    SELECT item_id, ws, least(len(ws), {_W}) AS size, unnest(range(1, len(ws) - least(len(ws), {_W}) + 2)) AS i FROM items WHERE len(ws) > 0
  )
),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT n, i, size, array_to_string(ws[i : i + size - 1], ' ') AS g
  FROM (SELECT n, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes WHERE len(ws) >= size)
),
found AS (SELECT n, i, p.size, item_id FROM places p JOIN windows w ON p.g = w.g AND p.size = w.size),
hits AS (SELECT n, count(DISTINCT i + k) AS n_hit FROM (SELECT n, i, unnest(range(size)) AS k FROM found) GROUP BY n),
named AS (SELECT n, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY n)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (n) LEFT JOIN named USING (n)
"""


@query("op9_decontaminate", LEAKS_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# 10. Personal data

PERSONAL_SQL = f"""
WITH {span_sql([
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "0"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "0"),
    ("card", r"[0-9]([\x20-]?[0-9])+", "0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "0"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)\b", "0"),
])},
digits AS (SELECT *, regexp_replace(found, '[^0-9]', '', 'g') AS d FROM placed),
kept AS (
  SELECT * FROM digits WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN regexp_full_match(found, '{personal.BYTE}(\\.{personal.BYTE}){{3}}')
    WHEN 'phone' THEN length(d) BETWEEN 8 AND 15
    WHEN 'iban' THEN list_reduce(
      [0] || list_transform(string_split(substr(replace(found, ' ', ''), 5) || substr(found, 1, 4), ''), lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE c::INT END),
      lambda x, v: (x * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1
    ELSE length(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN substr(d, length(d) - i + 1, 1)::INT
      ELSE substr(d, length(d) - i + 1, 1)::INT * 2 - CASE WHEN substr(d, length(d) - i + 1, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0
    END
),
per AS (
  SELECT n, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS c_{k}" for k in personal.BASE_KINDS)}, {joined_spans("rank, s", "kind <> 'iban'")} AS base,
    {joined_spans("rank, s")} AS spans
  FROM kept GROUP BY n
)
SELECT doc_id, {", ".join(f"coalesce(c_{k}, 0) AS n_{k}" for k in personal.BASE_KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM whole LEFT JOIN per USING (n)
"""


@query("op10_personal_data", PERSONAL_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = personal.find_personal(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*personal.BASE_KINDS))
    return found.select(
        "doc_id",
        *[number_of(k).alias(f"n_{k}") for k in personal.BASE_KINDS],
        F.sha2(span_digest(base), 256).alias("base_sha256"),
        span_digest(F.col("spans")).alias("spans"),
    )


# 11. Conversation structure repair


def crc32_sql(column: str) -> str:
    """SQL for the CRC-32 of an ASCII string: eight steps of the reflected polynomial for every character."""
    bits = "list_reduce([xor(x, b)] || range(8), lambda y, k: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)"
    return f"xor(list_reduce([4294967295] || list_transform(string_split({column}, ''), lambda c: ascii(c)::BIGINT), lambda x, b: {bits}), 4294967295)"


def repair_sql() -> str:
    """The cheapest audit by dynamic programming over rows: for every state the least (cost, initials)."""

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def plus(way: str, cost: str, initial: str, text: str = "''") -> str:
        return f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{initial}', 'd': {way}.d || {text}}}"

    def inserted(to: str, *before: str) -> str:
        role = {"u": "user", "a": "assistant"}[to]
        return best(f"{'s2' if to == 'u' else 's3'}", *[plus(b, "5", "I", f"chr(10) || '{role}:'") for b in before])

    far = "{'c': 1000000000, 'a': '', 'd': ''}"
    own, late = "chr(10) || r.role || ':' || r.text", "CASE r.fault WHEN 'truncated' THEN 5 ELSE 0 END"
    kept = {letter: f"CASE WHEN r.fault IN ('blank', 'duplicate') OR left(r.role, 1) <> '{letter}' THEN 1000000000 ELSE {late} END" for letter in "sua"}
    gone = f"CASE WHEN r.fault IN ('blank', 'duplicate') THEN 1000000000 ELSE 1 + {late} END"
    user, helper = "chr(10) || 'user:' || r.text", "chr(10) || 'assistant:' || r.text"
    into = {
        "s0": [plus("i0", "2", "D")],
        "s1": [plus("i1", "2", "D"), plus("i0", kept["s"], "K", own)],
        "s2": [plus("i2", "2", "D"), *[w for i in ("i0", "i1", "i3") for w in (plus(i, kept["u"], "K", own), plus(i, gone, "R", user))]],
        "s3": [plus("i3", "2", "D"), plus("i2", kept["a"], "K", own), plus("i2", gone, "R", helper)],
    }
    # Turns are inserted before a row or at the end; an inserted pair comes from a state that a single one can't reach.
    opened = f"""SELECT *, s0 AS i0, s1 AS i1, {inserted("u", "s0", "s1", "s3")} AS i2,
      {best("s3", plus("s2", "5", "I", "chr(10) || 'assistant:'"), plus("s0", "10", "II", "chr(10) || 'user:' || chr(10) || 'assistant:'"), plus("s1", "10", "II", "chr(10) || 'user:' || chr(10) || 'assistant:'"))} AS i3"""
    return f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h FROM conversations
),
damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies(k)
),
copies AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS copy FROM damaged),
r AS MATERIALIZED (
  SELECT *, left(lag(role) OVER o, 1) || left(role, 1) AS pair, row_number() OVER o AS n,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
      WHEN copy > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault
  FROM copies WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
),
convs AS MATERIALIZED (
  SELECT conv_id, count(*) AS total, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
),
steps AS (
  SELECT conv_id, total, 0::BIGINT AS n, {{'c': 0::BIGINT, 'a': '', 'd': ''}} AS s0, {far.replace("1000000000", "1000000000::BIGINT")} AS s1,
    {far.replace("1000000000", "1000000000::BIGINT")} AS s2, {far.replace("1000000000", "1000000000::BIGINT")} AS s3 FROM convs
  UNION ALL
  SELECT o.conv_id, total, r.n, {", ".join(f"{best(*ways)} AS {s}" for s, ways in into.items())}
  FROM ({opened} FROM steps) o JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id AND r.n = o.n + 1
),
ends AS (SELECT conv_id, {best("i0", "i3")} AS e FROM ({opened} FROM steps WHERE n = total)),
names AS (SELECT DISTINCT conv_id FROM conversations)
SELECT names.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.d, 2), '')) AS repaired_sha256
FROM names LEFT JOIN convs ON names.conv_id IS NOT DISTINCT FROM convs.conv_id LEFT JOIN ends ON names.conv_id IS NOT DISTINCT FROM ends.conv_id
"""


@query("op11_conversation_repair", repair_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return turns.audit_conversations(turns.damage(conversations), conversations)


# 12. Cross-tokenizer alignment


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align_tokenizers(table(spark, folder, "documents"), *paths, public_tokenizers.PATTERN)


# 13. Licence scans


def licence_sql(templates=licences.TEMPLATES) -> str:
    index = licences.rare_words(templates)
    words = ", ".join(
        f"({n}, '{t.label}', {t.base}, string_split('{t.text}', ' '), string_split('{t.key}', ' '), {t.key_from}, "
        f"{min(licences.AGREE, sum(1 for _, m, _ in index if m == n))})"
        for n, t in enumerate(templates)
    )
    return f"""
WITH templates(t, label, base, wanted, phrase, phrase_from, needed) AS (VALUES {words}),
rare(word, t, spot) AS (VALUES {", ".join(f"('{w}', {n}, {i})" for w, n, i in index)}),
d AS ({alnum_words("documents", "doc_id")}),
places AS (SELECT n, w, (i - 1)::BIGINT AS i FROM (SELECT n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d) WHERE w IN (SELECT word FROM rare)),
starts AS (SELECT n, rare.t, i - spot AS start, count(*) AS agreeing FROM places JOIN rare ON w = word GROUP BY n, rare.t, i - spot),
found AS (
  SELECT n, start, label, base,
    list_sum(list_transform(range(len(wanted)), lambda k: CASE WHEN start + k >= 0 AND ws[start + k + 1] = wanted[k + 1] THEN 1 ELSE 0 END)) / len(wanted) AS share
  FROM starts JOIN templates USING (t) JOIN d USING (n)
  WHERE agreeing >= needed AND start + phrase_from >= 0 AND ws[start + phrase_from + 1 : start + phrase_from + len(phrase)] = phrase
),
per AS (
  SELECT n, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found WHERE share >= 0.5 GROUP BY n
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per USING (n)
"""


@query("op13_licence_scan", licence_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan_licences(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", *[F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")], "score"
    )
