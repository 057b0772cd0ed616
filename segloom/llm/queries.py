"""The operators' registered queries, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, conversations, exact_dedup, jaccard, licenses, lm, media, packing, quality, secrets, token_store, url_filter
from .common import id_remainder, shared_path, table


def tokenizer_path() -> str:
    """The vocabulary file; LLM_TOKENIZER names another."""
    if own := os.environ.get("LLM_TOKENIZER"):
        return own
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store_media(table(spark, sf_dir, "documents"))
    read = media.media_features(stored, payload=True)
    feature = F.concat_ws(":", F.concat_ws("x", "width", "height"), "thumbnail_hash", F.crc32("thumbnail"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), target, tokenizer_path())
    return token_store.read_tokens(spark, target)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit_quality(documents, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(documents, model)
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.repair_report(turns, conversations.damage(turns))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_packing": op2_packing,
    "op3_media_columns": op3_media_columns,
    "op4_secret_scan": op4_secret_scan,
    "op5_lm_score": op5_lm_score,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_store": op7_token_store,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_license_scan": op11_license_scan,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}


def _template_rows() -> str:
    return ", ".join(f"({i}, '{t.label}', {str(t.phrase).lower()}, string_split('{' '.join(t.words)}', ' '))" for i, t in enumerate(licenses.templates()))


ORACLES = {
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op11_license_scan": rf"""
        WITH t(template, label, phrase, words) AS (VALUES {_template_rows()}),
        d AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{licenses.WORD}') AS ws FROM documents),
        b AS (SELECT row, ws, 32 * unnest(range((len(ws) + 31) // 32)) AS pos FROM d),
        p AS (SELECT row, template, label, phrase, pos, words, ws[pos + 1 : pos + 64] AS own, list_distinct(words) AS needed FROM b CROSS JOIN t WHERE list_has_any(ws[pos + 1 : pos + 64], words)),
        s AS (SELECT row, label, phrase, len(list_intersect(needed, own)) AS shared, len(needed) AS total,
              CASE WHEN phrase THEN list_filter(range(32), lambda i: own[i + 1 : i + len(words)] = words) END AS places, pos FROM p),
        m AS (SELECT row, label, CASE WHEN phrase THEN 1.0 ELSE shared / total END AS score, CASE WHEN phrase THEN len(places) ELSE 0 END AS n,
              pos + list_min(places) AS first, pos + list_max(places) AS last, phrase FROM s WHERE CASE WHEN phrase THEN len(places) > 0 ELSE 100 * shared >= 80 * total END),
        g AS (SELECT row, sum(n) AS n_base, min(first) AS first_word, max(last) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
              string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM m GROUP BY row)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
        FROM d LEFT JOIN g USING (row)""",
    "op12_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
        totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        starts AS (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w CROSS JOIN unnest(range(1, 5)) AS k(m)),
        f AS (SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT *, string_split(phrase, ' ') AS each FROM f WHERE m > 1),
        cut AS (SELECT c.lang, c.m, c.phrase, c.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS score
                FROM (SELECT *, unnest(range(1, m)) AS k FROM c) AS c
                JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(each[1 : k], ' ') JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(each[k + 1 : c.m], ' ')),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_ AS (SELECT lang, a, array_to_string(each[s : s + h - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, m - h + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS h FROM c WHERE m > 2))),
        kept AS (SELECT best.* FROM best LEFT JOIN (SELECT lang, phrase, max(a) AS most FROM inner_ GROUP BY ALL) AS o USING (lang, phrase) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * best.a::HUGEINT),
        ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score::BIGINT AS score FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
