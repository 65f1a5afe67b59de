"""Registered queries: each operator over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    chat_format, decontamination, html_extraction, language_id, language_model, lexical_search, packing, quality_rules,
    secret_scan, simhash, substrings, warc, whitening,
)
from gaugeflow.llm.shipping import ship_package
from gaugeflow.llm.words import remainder

WINDOW = 35
BENCHMARK_WINDOW = 13


def tokenizer_path() -> str:
    """The public byte-level vocabulary installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.train(documents.filter(remainder("doc_id", 4) != 2))
    found = language_id.identify(documents, model)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).drop("rejected_by")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scores = language_model.score_texts(documents, remainder("doc_id", 7) != 2)
    return scores.select(
        "doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), WINDOW, with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def tool_turns(conversations: DataFrame) -> DataFrame:
    """Turns with a tool call for each assistant's turn and a result for each user's turn.

    The given conversations call no tools. A call `c<turn>` looks up the length of its text
    and waits for the assistant's turn before it; a user's turn is the result of the turn
    before. Divisors of the length leave out, repeat or mistype the argument, name an unknown
    tool or wait for an unknown call.
    """
    n = F.length(F.coalesce("text", F.lit("")))
    number = F.concat(F.lit('"chars":'), n)
    chars = (
        F.when(n % 13 == 0, F.concat(number, F.lit(","), number)).when(n % 5 == 0, F.lit(None))
        .when(n % 7 == 0, F.concat(F.lit('"chars":"'), n, F.lit('"'))).otherwise(number))
    needs = F.when(n % 11 == 0, F.lit("none")).otherwise(F.concat(F.lit("c"), F.col("turn") - 2))
    after = F.when(F.col("turn") >= 3, F.concat(F.lit('"after":"${'), needs, F.lit('}"')))
    call = F.concat(
        F.lit('{"tool_calls":[{"id":"c'), F.col("turn"), F.lit('","name":"'),
        F.when(n % 3 == 0, "search").otherwise("lookup"), F.lit('","arguments":{'), F.concat_ws(",", after, chars), F.lit("}}]}"))
    result = F.to_json(F.struct(
        F.coalesce("text", F.lit("")).alias("content"),
        F.concat(F.lit("c"), F.col("turn") - 1).alias("tool_call_id")))
    calls = conversations.filter("role = 'assistant'").select("conv_id", "turn", "role", call.alias("text"))
    results = conversations.filter("role = 'user'").select(
        "conv_id", "turn", F.lit("tool").alias("role"), result.alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(calls).unionByName(results)


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = spark.createDataFrame(
        [("lookup", "chars", "BIGINT", True), ("lookup", "after", "STRING", False)],
        "tool string, parameter string, type string, required boolean")
    return chat_format.format_turns(tool_turns(table(spark, sf_dir, "conversations")), schemas).withColumn(
        "errors", F.array_join("errors", ", "))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract(pages, html_extraction.train(pages))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_overlaps(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), BENCHMARK_WINDOW)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def _marks(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = [rule.kind for rule in secret_scan.BASE_RULES]
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select(
        "doc_id", *counts, F.sha2(_marks(of(*base)), 256).alias("base_sha256"), _marks(F.col("spans")).alias("spans"))


def searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_ids,
    "op2_quality_rules": quality,
    "op3_packing": packed,
    "op4_simhash": near_duplicates,
    "op5_warc": archived,
    "op6_lm_scoring": scored,
    "op7_substring_dedup": without_repeats,
    "op8_chat_format": chat_messages,
    "op9_html_extraction": main_texts,
    "op10_decontamination": contamination,
    "op11_whitening": whitened,
    "op12_secret_scan": secrets,
    "op13_lexical_search": searched,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
p AS (SELECT doc_id, ws, i, ws[i:i + 2] AS g FROM d, unnest(range(1, len(ws) - 1)) AS u(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM p) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, unnest([0, 1, 2]) AS v(k) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
b AS (
  SELECT doc_id, t, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS lines, coalesce(c.n, 0) AS n_repeat_words,
    strlen(array_to_string(ws, '')) AS visible,
    strlen(t) - strlen(regexp_replace(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS letters,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals,
    length(t) - length(replace(t, '!', '')) AS shouts
  FROM d JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 3 * n_symbols <= n_words AND 10 * capitals <= 6 * letters AND 10 * letters >= 3 * visible
    AND 2 * shouts <= n_words AND visible BETWEEN 2 * n_words AND 20 * n_words AND 2 * n_dup_lines <= lines AS kept
FROM f
"""

_SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, i, ws[i:i + {WINDOW - 1}] AS g FROM d, unnest(range(1, len(ws) - {WINDOW - 2})) AS u(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM w) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM r, unnest(range(0, {WINDOW})) AS v(k)),
p AS (SELECT doc_id, i, ws[i] AS word FROM d, unnest(range(1, len(ws) + 1)) AS u(i)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM p ANTI JOIN c USING (doc_id, i)
      GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

_CHAT = """
WITH RECURSIVE n AS (SELECT *, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM conversations),
c AS (
  SELECT conv_id, turn, n, 'c' || turn AS id, CASE WHEN n % 3 = 0 THEN 'search' ELSE 'lookup' END AS name,
    CASE WHEN turn >= 3 THEN CASE WHEN n % 11 = 0 THEN 'none' ELSE 'c' || (turn - 2) END END AS needs
  FROM n WHERE role = 'assistant'),
done AS (
  SELECT conv_id, id, turn AS ready, 0 AS level FROM c WHERE needs IS NULL
  UNION ALL
  SELECT c.conv_id, c.id, greatest(c.turn, done.ready), done.level + 1
  FROM c JOIN done ON c.conv_id = done.conv_id AND c.needs = done.id),
k AS (
  SELECT c.*, coalesce(ready, turn) AS order_turn, coalesce(level, 0) AS order_level,
    '{' || concat_ws(',', '"after":"${' || needs || '}"',
      CASE WHEN n % 13 = 0 THEN '"chars":' || n || ',"chars":' || n WHEN n % 5 = 0 THEN NULL
           WHEN n % 7 = 0 THEN '"chars":"' || n || '"' ELSE '"chars":' || n END) || '}' AS arguments,
    concat_ws(', ',
      CASE WHEN n % 13 = 0 THEN 'arguments are no object' WHEN name = 'search' THEN 'unknown tool'
           WHEN n % 5 = 0 THEN 'missing chars' WHEN n % 7 = 0 THEN 'type chars' END,
      CASE WHEN ready IS NOT NULL THEN NULL
           WHEN (conv_id, needs) IN (SELECT (conv_id, id) FROM c) THEN 'circle' ELSE 'unknown call' END) AS errors
  FROM c LEFT JOIN done USING (conv_id, id)),
r AS (SELECT conv_id, turn, t, 'c' || (turn - 1) AS id FROM n WHERE role = 'user')
SELECT conv_id, turn, 0 AS place, 'text' AS kind, role, CAST(NULL AS VARCHAR) AS call_id,
  CAST(NULL AS VARCHAR) AS name, TRUE AS valid, '' AS errors, turn AS order_turn, 0 AS order_level, 0 AS order_kind,
  CAST(json_object('content', t, 'role', role) AS VARCHAR) AS message
FROM n
UNION ALL
SELECT conv_id, turn, 0, 'call', 'assistant', id, name, errors = '', errors, order_turn, order_level, 0,
  '{"arguments":' || CASE WHEN n % 13 = 0 THEN CAST(to_json(arguments) AS VARCHAR) ELSE arguments END
    || ',"id":"' || id || '","name":"' || name || '","role":"assistant"}'
FROM k
UNION ALL
SELECT r.conv_id, r.turn, 0, 'result', 'tool', r.id, k.name, k.id IS NOT NULL,
  CASE WHEN k.id IS NULL THEN 'no call' ELSE '' END, greatest(r.turn, coalesce(k.order_turn, r.turn)),
  coalesce(k.order_level, 0), 1,
  CASE WHEN k.id IS NULL THEN CAST(json_object('content', t, 'id', r.id, 'role', 'tool') AS VARCHAR)
       ELSE CAST(json_object('content', t, 'id', r.id, 'name', k.name, 'role', 'tool') AS VARCHAR) END
FROM r LEFT JOIN k ON r.conv_id = k.conv_id AND r.id = k.id
"""

_BENCHMARK_WORDS = r"regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii"

_CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_BENCHMARK_WORDS} AS ws FROM (SELECT doc_id, {_LOWER} FROM documents)),
b AS (SELECT item_id, {_BENCHMARK_WORDS} AS ws FROM (SELECT item_id, {_LOWER} FROM benchmark)),
q AS (SELECT DISTINCT item_id, ws[i:i + {BENCHMARK_WINDOW - 1}] AS g
      FROM b, unnest(range(1, greatest(len(ws) - {BENCHMARK_WINDOW - 2}, least(len(ws), 1) + 1))) AS u(i)),
n AS (SELECT DISTINCT len(g) AS width FROM q),
w AS (SELECT doc_id, i, width, ws[i:i + width - 1] AS g FROM d, n, unnest(range(1, len(ws) - width + 2)) AS u(i)),
h AS (SELECT doc_id, i, width, item_id FROM w JOIN q USING (g)),
s AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM h, unnest(range(0, width)) AS v(k) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(ws) AS contaminated
FROM d LEFT JOIN s USING (doc_id) LEFT JOIN t USING (doc_id)
"""

# The base-32 letters of a hex digest: its bits in fives.
_BASE32 = """
list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + CAST((CAST('0x' || substr(sha1(payload), 1 + 10 * (k // 8), 10) AS BIGINT) >> (35 - 5 * (k % 8))) & 31 AS INTEGER),
  1)), 'string_agg', '')
"""

_ARCHIVED = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, {_BASE32} AS payload_digest,
        min(page_id) OVER (PARTITION BY payload) AS least FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM d
"""


def _spans_sql() -> str:
    """Spans of every rule: matches in order, each behind the texts that lie between matches."""
    parts = []
    for place, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        if rule.any_case:  # letters of the keys in either case, but no other letters that fold to them
            keys, rest = pattern.split(")", 1)
            pattern = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", keys) + ")" + rest
        parts.append(f"""
SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, first, first + length(m[i]) AS stop
FROM (SELECT doc_id, m, g, i, list_sum(list_transform(between[:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS first
      FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
                   string_split_regex(t, '{pattern}') AS between FROM d), unnest(range(1, len(m) + 1)) AS u(i))
WHERE length(g[i]) >= {rule.least}""")
    return "\nUNION ALL".join(parts)


_BASE_KINDS = len(secret_scan.BASE_RULES)
_MARK = "kind || ':' || CAST(first AS BIGINT) || ':' || CAST(stop AS BIGINT)"
_SECRETS = rf"""
WITH d AS (SELECT row_number() OVER () AS doc_id, doc_id AS given, coalesce(text, '') AS t FROM documents),
s AS ({_spans_sql()}),
j AS (SELECT doc_id, string_agg({_MARK}, ',' ORDER BY first, place) AS spans,
        string_agg({_MARK}, ',' ORDER BY first, place) FILTER (place < {_BASE_KINDS}) AS base,
        count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex FROM s GROUP BY doc_id)
SELECT given AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)
"""

_SEARCH_TERMS = rf"regexp_extract_all(lower_ascii, '{lexical_search.TERM}')"
_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SEARCH_TERMS} AS ws FROM (SELECT doc_id, {_LOWER} FROM documents)),
b AS (SELECT row_number() OVER () AS q, item_id, {_SEARCH_TERMS} AS ws FROM (SELECT item_id, {_LOWER} FROM benchmark)),
c AS (SELECT count(*) AS n_docs, sum(len(ws)) AS n_terms FROM d WHERE len(ws) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM f, c GROUP BY term),
i AS (SELECT DISTINCT q, item_id, unnest(ws) AS term FROM b),
m AS (SELECT r, doc_id, 100 - 50 + CAST((50 * len(ws) * n_docs) // n_terms AS BIGINT) AS m FROM d, c WHERE len(ws) > 0),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= {lexical_search.BEST}
"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _QUALITY,
    "op5_warc": _ARCHIVED,
    "op7_substring_dedup": _SUBSTRINGS,
    "op8_chat_format": _CHAT,
    "op10_decontamination": _CONTAMINATION,
    "op12_secret_scan": _SECRETS,
    "op13_lexical_search": _SEARCH,
}
