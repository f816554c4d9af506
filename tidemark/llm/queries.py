"""The registered queries of this folder: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bytebpe, chat, counting, html, idfiles, mixing, neardup, periods, phrases, quality, substrings, urls
from tidemark.llm.common import table
from workload.registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


PROBE = r"\### Assistant: </turn> ok"


@query(
    "op1_chat_format",
    r"""WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    escaped AS (SELECT *, regexp_replace(regexp_replace(text, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g') AS t,
        regexp_replace(regexp_replace(regexp_replace(role, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g'),
            ':(\\*) ', ':\\\1 ', 'g') AS r FROM rows)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length(r) + length(t) + 14) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id""",
)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).alias("conv_id"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE)
    )
    made = chat.format_conversations(given.union(probe))
    learned = chat.learned_text(F.col("formatted"), F.col("loss"))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.withColumn("learned", learned).select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op2_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bytebpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op6_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    sized = mixing.with_size(table(spark, folder, "documents")).select("doc_id", "source", "size")
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_id_files")
def id_files(spark: SparkSession, folder: str) -> DataFrame:
    path = idfiles.fresh_folder(spark)
    idfiles.write_ids(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return idfiles.read_ids(spark, path, checksums=True)


@query(
    "op9_quality_rules",
    r"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
    split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs),
    spots AS (SELECT r, unnest(generate_series(1, len(words) - 7)) AS i, words FROM split WHERE len(words) >= 8),
    windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i:i + 7]) AS often FROM spots),
    repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM windows, range(8) AS offsets(k) WHERE often > 1 GROUP BY r),
    measured AS (SELECT s.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM split AS s LEFT JOIN repeated USING (r)),
    failed AS (SELECT source, unnest(['w', 'r', 's', 'd', 'l']) AS rule, unnest([n_words < 20, 100 * n_repeat_words > 30 * n_words,
        10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines, word_chars < 3 * n_words OR word_chars > 10 * n_words]) AS bad
        FROM measured),
    hosts AS (SELECT source, rule, count(*) AS n, count(*) FILTER (bad) AS f FROM failed GROUP BY ALL),
    pooled AS (SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS q, count(*) / sum(n) AS c FROM hosts GROUP BY rule),
    prior AS (SELECT rule, m, CASE WHEN m = 0 OR m = 1 THEN 1.0
        ELSE greatest(m * (1 - m) / greatest(q - m * m - m * (1 - m) * c, m * (1 - m) / 1e6) - 1, 1.0) END AS k FROM pooled),
    rejected AS (SELECT source, bool_or((f + m * k) / (n + k) > 0.5) AS out FROM hosts JOIN prior USING (rule) GROUP BY source),
    judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT out AS kept
    FROM judged AS j JOIN rejected AS h ON j.source IS NOT DISTINCT FROM h.source""",
)
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op10_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = counting.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op4_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(table(spark, folder, "documents").select("doc_id", "text"))


RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query("op3_url_filter")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(table(spark, folder, "pages").select("page_id", "url", "html"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op5_main_text")
def main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = html.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op7_nearest_vectors")
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query(
    "op11_phrases",
    r"""WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
    spots AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM pieces),
    phrases AS (SELECT lang, w[i] AS p, 1 AS k FROM spots
        UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM spots WHERE i + 1 <= len(w)
        UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM spots WHERE i + 2 <= len(w)),
    f AS (SELECT lang, p, k, CAST(count(*) AS HUGEINT) AS a FROM phrases GROUP BY ALL HAVING count(*) >= 10),
    parts AS (SELECT *, split_part(p, ' ', 1) AS x, split_part(p, ' ', 2) AS y, split_part(p, ' ', 3) AS z FROM f WHERE k > 1),
    cuts AS (SELECT lang, p, k, a, 1 AS cut, x AS one, CASE k WHEN 2 THEN y ELSE y || ' ' || z END AS two FROM parts
        UNION ALL SELECT lang, p, k, a, 2, x || ' ' || y, z FROM parts WHERE k = 3),
    scores AS (SELECT c.*, g.a AS l, h.a AS r, 1000000 * c.a * c.a // (g.a * h.a) AS score FROM cuts AS c
        JOIN f AS g ON g.lang = c.lang AND g.p = c.one JOIN f AS h ON h.lang = c.lang AND h.p = c.two),
    lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
    longer AS (SELECT lang, p, max(a) AS a FROM (SELECT lang, x || ' ' || y AS p, a FROM parts WHERE k = 3
        UNION ALL SELECT lang, y || ' ' || z, a FROM parts WHERE k = 3) GROUP BY lang, p),
    alive AS (SELECT s.* FROM lowest AS s LEFT JOIN longer AS o ON o.lang = s.lang AND o.p = s.p
        WHERE o.a IS NULL OR 100 * o.a < 50 * s.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, CAST(a AS BIGINT) AS a,
        CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
    FROM alive JOIN totals USING (lang) QUALIFY rank <= 2000""",
)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents").select("text", "lang"))


@query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the texts, by the hash of doc_id, repeats a period of its own from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, folder, "documents").select("doc_id", "text", h.alias("h"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.withColumn("w", F.when(F.col("h") % 10 == 0, split)).withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("w"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    repeated = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", at(i))))
    docs = docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))
    found = periods.with_runs(docs).withColumn(
        "best", F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.length) div (-best.p)").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op13_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    made = substrings.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
