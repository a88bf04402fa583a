"""The registered queries of the subpackage and their DuckDB text where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import bpe, content, exact, lattice, mixing, near, negatives, private, quality, repeats, tokens, urls, whiten
from reviewmill.llm.common import table
from reviewmill.session import keep

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        LLM_QUERIES[function.__name__] = function
        if sql is not None:
            LLM_ORACLES[function.__name__] = sql
        return function

    return register


@_query()
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    judged = quality.judge(keep(quality.measure(docs), "quality"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *(f"q.{c}" for c in counts), "base_failed", "kept")


@_query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query(
    """
    WITH texts AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents
    ), digests AS (SELECT doc_id, sha256(body) AS text_sha256 FROM texts)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = min(doc_id) OVER same AS kept, text_sha256
    FROM digests WINDOW same AS (PARTITION BY text_sha256)
    """
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.exact_groups(docs, new=exact.first_half(docs))


@_query()
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


@_query()
def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.chosen_path_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query()
def op1_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private.find_private(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in private.KINDS]
    added = (F.size("spans") - F.size(base)).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), added)


@_query()
def op3_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = content.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


#: The contract's rules.
URL_RULES = [
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


@_query()
def op2_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = urls.filter_urls(pages, URL_RULES)
    return judged.select("page_id", *(f"judged.{c}" for c in ("host", "path", "rule", "verdict", "template", "purity")))


@_query()
def op10_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return lattice.score_texts(docs, held_out, public_tokenizers.path("piece_bpe_32k.model"))


@_query()
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query()
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), limit=4096)
    return counted.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


@_query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fitted = whiten.fit_whitening(rows, "embedding", components=16)
    explained = F.array(*map(F.lit, fitted.explained.tolist())) if len(fitted.explained) else F.array().cast("array<double>")
    white = whiten.whiten(rows, fitted, "embedding").select(
        "vec_id", F.col("white.deviation").cast("long").alias("deviation"), F.posexplode("white.whitened").alias("place", "whitened")
    )
    return white.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(fitted.identity_error).alias("identity_error"),
    )


@_query(
    """
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
            CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
        WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT p.anchor_id, p.positive_id,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
        n.other_id AS negative_id, p.positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
    QUALIFY rank <= 10
    """
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    number = F.col("label").cast("long")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (number + 1) % 10).otherwise(number))
    return negatives.hard_negatives(rows, anchors=F.col("vec_id") % 100 == 0)
