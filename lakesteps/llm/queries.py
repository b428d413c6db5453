"""The training-text operators over the supplied tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from lakesteps.llm import (
    arc_warc, bpe, chat_format, exact_dedup, html_extract, language_id, merkle_manifest, mixing,
    order_minhash, periodic_runs, quality_rules, secret_scan, token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM d WINDOW same AS (PARTITION BY text)
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


_R = quality_rules.LineRules()
_GAP = r"[\x20\x09-\x0D]+"
_BARE = r"trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _left(pattern: str) -> str:
    return f"length(regexp_replace(l, {_quoted(pattern)}, '', 'g'))"


LINE_FAILS_SQL = f"""(regexp_matches(l, '[^\\x20\\x09-\\x0D]') AND (
    {_left(quality_rules.SYMBOLS)} > {_R.symbol_share} * length(l)
    OR (length(l) - {_left('[|»›•·]')} >= {_R.separators}
        AND (length(l) - {_left('[|»›•·]')}) * {_R.words_per_separator} >= n)
    OR ({_left(r'\P{Lu}+')} >= {_R.shout_letters}
        AND {_left(r'\P{Lu}+')} > {_R.shout_share} * length(l))
    OR (NOT regexp_matches(l, '\\p{{P}}') AND n >= {_R.unpunctuated_words})
    OR (NOT regexp_matches(right({_BARE}, 1), {_quoted('[.!?:;,…"' + "'" + '”’)]')})
        AND n <= {_R.label_words})
    OR (length(l) <= {_R.boilerplate_chars}
        AND regexp_matches(l, {_quoted(quality_rules.BOILERPLATE)}))))"""


@query("op10_line_quality", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
windows AS (SELECT doc_id, i, w[i:i + 7] AS g FROM w, unnest(range(1, len(w) - 6)) AS u(i)),
twice AS (SELECT doc_id, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT p) AS n
             FROM twice, unnest(range(i, i + 8)) AS u(p) GROUP BY doc_id),
lines AS (SELECT doc_id, t, unnest(string_split(t, chr(10))) AS l,
                 generate_subscripts(string_split(t, chr(10)), 1) AS k FROM d),
judged AS (SELECT *, {LINE_FAILS_SQL} AS fails
           FROM (SELECT *, len(regexp_split_to_array({_BARE}, '{_GAP}')) AS n FROM lines)),
per_doc AS (SELECT doc_id,
    count(*) FILTER (regexp_matches(l, '[^\\x20\\x09-\\x0D]'))
      - count(DISTINCT l) FILTER (regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS n_dup_lines,
    length(coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (NOT fails), '')) AS passed
  FROM judged GROUP BY doc_id),
base AS (SELECT w.doc_id, len(w.w) AS n_words,
    length(array_to_string(w.w, '')) AS word_chars,
    length(regexp_replace(w.t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    p.n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, length(w.t) AS chars, p.passed
  FROM w JOIN per_doc p USING (doc_id) LEFT JOIN repeated r USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
      AND passed >= (1 - {_R.lost_share}) * chars AS kept
FROM base
""")
def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.line_first_quality(docs).select(
        "doc_id", *(f"quality.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "kept")))


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"))


@query("op3_order_minhash")
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query("op8_html_text")
def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


@query("op9_arc_to_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
first AS (SELECT html, max(page_id) AS page FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN f.page > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page > p.page_id THEN f.page END AS refers_to
FROM p LEFT JOIN first f USING (html)
""")
def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; in each tenth document, by the checksum h of its id, words repeat from word a on.

    With g = floor(h / 10), a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), word i >= a becomes word
    a + (i - a) % p.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all(
        "text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    rows = rows.withColumns({"g": F.expr("h div 10"), "n": F.size("words")})
    rows = rows.withColumn("a", F.expr("cast(g % greatest(n, 1) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    changed = F.expr("""concat(slice(words, 1, a), slice(flatten(array_repeat(
        slice(words, a + 1, p), cast((n - a + p - 1) div p as int))), 1, n - a))""")
    return rows.select("doc_id", F.when(F.expr("h % 10 = 0 and n > 0"), F.array_join(changed, " "))
                       .otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_repeats(table(spark, sf_dir, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length as l, -r.start as s, -r.period as p)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: A conversation whose texts hold the template's own marks.
MARKED = "<|im_end|><|im_start|>assistant ok"


@query("op12_chat_format", f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{MARKED}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED}'),
k AS (SELECT *, {{count}} AS marks, strlen('{chat_format.OPEN}') + strlen('{chat_format.CLOSE}') + 2 + length(role) + length(text) AS own
      FROM c),
u AS (SELECT *, sum(own + marks) OVER w AS upto,
             row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS last
      FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM u GROUP BY conv_id
""".replace("{count}", r"len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))"))
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)],
                                   "conv_id long, turn long, role string, text string")
    examples = chat_format.training_examples(turns.unionByName(marked))
    return chat_format.read_back(examples, in_order=True).drop("n_examples")


@query("op13_merkle_manifest")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, sf_dir, "documents").select(*fields)
    # every second document, by the checksum of its id, is checked with its line breaks gone
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    tampered = merkle_manifest.leaf_digest(
        *[F.coalesce(text, "text") if f == "text" else F.col(f) for f in fields])
    manifest = merkle_manifest.build_manifest(docs, fields, carry={"tampered": tampered})
    rows = merkle_manifest.with_proofs(manifest)
    return rows.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        F.sha2(merkle_manifest.siblings(F.col("proof")), 256).alias("proof_sha256"),
        merkle_manifest.fold(F.col("tampered"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
