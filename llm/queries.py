"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import alignment, chat, divergence, exact, jaccard, licenses, mixing, packing, pii, quality, urls, vectors, warc
from llm.shared import documents, stored


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured once: the narrow measurements are stored, then fitted and judged."""
    found = stored(quality.measured(documents(spark, sf_dir).select("doc_id", "text")).drop("text"), "quality")
    model = quality.fit(quality.vote_patterns(found))
    columns = ("doc_id", *quality.METRICS[:5], "base_failed", "kept", "quality")
    return quality.judged(found, model).select(*columns)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = exact.looked_up(docs, exact.build_index(docs))
    return found.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TRICKY = "\\### Assistant: </turn> ok"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))]))
    tricky = spark.range(1).select(turns.alias("t")).select(F.lit(-7).cast("long").alias("conv_id"), "t.*", F.lit(TRICKY).alias("text"))
    return chat.digests(chat.formatted(rows.unionByName(tricky)))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).drop("url")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(documents(spark, sf_dir).select("doc_id", "text"), secret="example key")


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(documents(spark, sf_dir).select("doc_id", "source"))
    return found.select("_row.doc_id", "_row.source", "block", "slot", "place")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(documents(spark, sf_dir))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(documents(spark, sf_dir).select("doc_id", "text"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


TEMPLATE_ROWS = ", ".join(f"('{name}', {bigrams})" for name, bigrams in licenses.prepared())

ORACLES = {
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
            FROM documents),
        occ AS (
            SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM d),
        kept AS (SELECT lang, term FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        groups AS (SELECT DISTINCT lang, source FROM d),
        cnt AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM occ o JOIN kept k ON k.lang = o.lang AND k.term = o.term GROUP BY ALL),
        grid AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v.v
            FROM groups g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
            LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        gp AS (
            SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM grid),
        lsum AS (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM grid GROUP BY lang, term),
        lq AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM lsum),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM gp a JOIN gp b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
            SELECT g.lang, g.source, h.source AS item, coalesce(s.value, 0) AS value
            FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
            LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = h.source),
        over AS (SELECT gp.lang, gp.source, gp.term AS item, p - q AS value FROM gp JOIN lq ON lq.lang = gp.lang AND lq.term = gp.term WHERE n > 0 AND p > q),
        ranked AS (
            SELECT lang, source, 'pair' AS part, item, value,
                   row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
            UNION ALL
            SELECT lang, source, 'term', item, value,
                   row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM over)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
        WHERE part = 'pair' OR rank <= 50
    """,
    "op2_exact_dedup": """
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        ranked AS (
            SELECT doc_id, text_sha256,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM plain)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
    """,
    "op3_warc": r"""
        WITH paid AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        bits AS (
            SELECT page_id, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS last,
                   array_to_string(list_transform(range(1, 41), lambda i: format('{:04b}', strpos('0123456789abcdef', sha1(html)[i]) - 1)), '') AS b
            FROM paid)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda g: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
                   1 + 16 * CAST(b[5 * g + 1] AS INT) + 8 * CAST(b[5 * g + 2] AS INT) + 4 * CAST(b[5 * g + 3] AS INT)
                   + 2 * CAST(b[5 * g + 4] AS INT) + CAST(b[5 * g + 5] AS INT)]), '') AS payload_digest,
               CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < last THEN last END AS refers_to
        FROM bits
    """,
    "op4_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        sized AS (
            SELECT *, length(replace(replace(replace(text, '\', '\\'), '### ', '\m'), '</turn>', '\e')) + 8
                   + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
                     ELSE 11 + length(hex(role)) END AS chars
            FROM turns),
        whole AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   CAST(sum(chars) AS BIGINT) AS formatted_chars,
                   string_agg(CASE WHEN role IN ('system', 'user', 'assistant') THEN role[1] ELSE 'x' END, '' ORDER BY turn, role, text) AS roles
            FROM sized GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               formatted_chars, regexp_full_match(roles, 's?(ua)+') AS valid
        FROM whole
    """,
    "op7_ngram_jaccard_join": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, s FROM (
                SELECT doc_id, unnest(CASE
                    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
                FROM worded)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        links AS (
            SELECT x, y FROM shared h JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * h.n >= 80 * (p.n + q.n - h.n)),
        reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
        SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, least(d.doc_id, min(r.y)) AS component_id
        FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.x = d.doc_id GROUP BY d.doc_id
    """,
    "op9_license_scans": rf"""
        WITH templates(name, t) AS (VALUES {TEMPLATE_ROWS}),
        units AS (
            SELECT DISTINCT doc_id, unnest(list_concat(regexp_split_to_array(text, '\r?\n'),
                   regexp_split_to_array(text, '\r?\n[\x20\t]*\r?\n'), [text])) AS u
            FROM documents),
        worded AS (
            SELECT doc_id, u, regexp_extract_all(translate(u, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS w
            FROM units),
        paired AS (
            SELECT doc_id, u, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM worded
            WHERE len(w) BETWEEN 2 AND 1000),
        scored AS (
            SELECT doc_id, u, name, 2.0 * len(list_intersect(b, t)) / CAST(len(b) + len(t) AS DOUBLE) AS dice
            FROM paired, templates WHERE len(b) BETWEEN 0.6 * len(t) AND 1.6 * len(t)),
        best AS (SELECT doc_id, u, max({{'dice': dice, 'name': name}}) AS m FROM scored WHERE dice >= 0.8 GROUP BY doc_id, u),
        found AS (SELECT doc_id, max(m) AS m, count(*) AS n FROM best GROUP BY doc_id)
        SELECT d.doc_id, f.m.name AS license, f.m.dice AS dice, coalesce(f.n, 0) AS n_notices
        FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id
    """,
    "op6_url_filters": r"""
        WITH parts AS (
            SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
                WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
            FROM parts)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host LIKE '%casino%' OR host LIKE '%adult%' OR host LIKE '%free-bets%' OR host LIKE '%spam%' THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled
    """,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_exact_dedup": op2_exact_dedup,
        "op3_warc": op3_warc,
        "op4_chat_formatting": op4_chat_formatting,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_url_filters": op6_url_filters,
        "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
        "op8_pii_surrogates": op8_pii_surrogates,
        "op9_license_scans": op9_license_scans,
        "op10_source_mixing": op10_source_mixing,
        "op11_source_divergence": op11_source_divergence,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_embedding_near_dedup": op13_embedding_near_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
