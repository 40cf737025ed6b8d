"""The registered queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkgrain.llm.decontaminate import contaminated, contamination_digest
from talkgrain.llm.interactions import audit_filters
from talkgrain.llm.kneser_ney import judge_perplexity
from talkgrain.llm.language import identify_languages
from talkgrain.llm.mixture import pack_mixture
from talkgrain.llm.packing import pack
from talkgrain.llm.pii import find_pii, pii_digest
from talkgrain.llm.quality import judge_quality
from talkgrain.llm.resample import resample
from talkgrain.llm.secrets import find_secrets, secrets_digest
from talkgrain.llm.simhash import near_duplicates
from talkgrain.llm.substrings import dedup_substrings
from talkgrain.llm.token_ids import token_digest, write_token_ids
from talkgrain.sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

# Stated, so that no job runs to infer them.
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(_documents(spark, sf_dir))
    return judged.withColumn("votes", F.array_join(F.col("votes").cast("array<string>"), ","))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = _table(spark, sf_dir, "benchmark")
    return contamination_digest(contaminated(_documents(spark, sf_dir), benchmark))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(find_pii(_documents(spark, sf_dir)))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir)).drop("group_id", "_key")


def op7_secrets(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """``ledger`` is a lasting folder: what it holds from earlier runs is not scanned again."""
    ledger = ledger or shared_folder(spark, "secret-ledger")
    return secrets_digest(find_secrets(_documents(spark, sf_dir), ledger))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_folder(spark, "token-ids")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    write_token_ids(_documents(spark, sf_dir), tokenizer, folder, end_id=1)
    return token_digest(spark, folder)


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels")
    trusted = labels.where("quality = 1 AND toxic = 0")
    return judge_perplexity(_documents(spark, sf_dir), trusted, labels.where("toxic = 1"))


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_documents(spark, sf_dir)).drop("kept_text")


def op11_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_mixture(_documents(spark, sf_dir), tokenizer, end_id=1)


def op12_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    return {
        "op1_language": op1_language,
        "op2_packing": op2_packing,
        "op3_quality": op3_quality,
        "op4_decontamination": op4_decontamination,
        "op5_pii": op5_pii,
        "op6_simhash": op6_simhash,
        "op7_secrets": op7_secrets,
        "op8_token_ids": op8_token_ids,
        "op9_quality_model": op9_quality_model,
        "op10_substrings": op10_substrings,
        "op11_mixture": op11_mixture,
        "op12_interactions": op12_interactions,
        "op13_resample": op13_resample,
    }


# Places count from 1 here. The tables have no null ids.
_SUBSTRINGS = r"""
WITH cut AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM cut)),
firsts AS (SELECT k, min(doc_id) AS first FROM windows GROUP BY k),
repeated AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM repeated, range(50) AS t(j)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM cut),
marked AS (
    SELECT words.*, gone.p IS NOT NULL AS removed
    FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (removed) AS n_removed,
           string_agg(word, ' ' ORDER BY p) FILTER (NOT removed) AS kept
    FROM marked GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""

_CONTAMINATED = r"""
WITH plain AS (
    SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
    UNION ALL SELECT 'i', item_id, coalesce(text, '') FROM benchmark),
cut AS (
    SELECT side, id, list_filter(
        regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
        lambda w: w <> '') AS w
    FROM plain),
items AS (
    SELECT DISTINCT id AS item_id, w[i:i + n - 1] AS win, n
    FROM (SELECT id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 8, 2))) AS i
          FROM cut WHERE side = 'i' AND len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM items),
windows AS (
    SELECT id AS doc_id, n, i, w[i:i + n - 1] AS win
    FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM cut, lengths WHERE side = 'd' AND len(w) >= n)),
hits AS (
    SELECT doc_id, i, windows.n, item_id FROM windows JOIN items USING (win)),
places AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::varchar AS item FROM hits) GROUP BY doc_id)
SELECT cut.id AS doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN n_hits ON cut.id = n_hits.doc_id LEFT JOIN found ON cut.id = found.doc_id
WHERE side = 'd'"""


_INTERACTIONS = r"""
WITH cut AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, list_filter(
        regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
judged AS (
    SELECT part, doc_id,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)
           THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' ELSE '' END AS failed
    FROM cut),
marks AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
combos AS (
    SELECT part, failed, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           count(*) AS n
    FROM judged LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, k::int AS step, filter_order[k] AS own, filter_order[1:k - 1] AS before
    FROM orders, range(1, 6) AS t(k)),
each AS (
    SELECT *, contains(failed, own) AS fails,
           before = '' OR NOT regexp_matches(failed, '[' || before || ' ]') AS came
    FROM combos, steps),
counted AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (NOT fails AND came), 0)::bigint AS kept,
           coalesce(sum(n) FILTER (fails AND came), 0)::bigint AS removed,
           coalesce(sum(n) FILTER (fails AND NOT came), 0)::bigint AS redundant,
           coalesce(sum(n) FILTER (failed = own), 0)::bigint AS unique_fails,
           coalesce(sum(n) FILTER (fails AND came AND good), 0)::bigint AS good_lost,
           coalesce(sum(n) FILTER (fails AND came AND toxic), 0)::bigint AS toxic_lost
    FROM each GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::bigint AS shapley
FROM counted"""


def oracle_sql() -> dict[str, str]:
    """Fingerprints, fitted models, tokenizers and guarded patterns are not expressed in SQL;
    those queries are tested against plain versions."""
    return {
        "op4_decontamination": _CONTAMINATED,
        "op10_substrings": _SUBSTRINGS,
        "op12_interactions": _INTERACTIONS,
    }
