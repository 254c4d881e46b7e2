"""The subpackage's queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelog.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_wrappers,
    near_dedup,
    pii,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
    vector_codes,
    warc,
)
from gatelog.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: Tokenizer files, installed on every machine.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def categories() -> dict[str, Column]:
    """The chain's categories, in order, as columns of ``labels``; toxic decides."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents")).drop("spans")


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents")).drop("n_chars")


def op4_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.by_row(table(spark, sf_dir, "documents"), PIECES)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op8_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents")).drop("text_key")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), categories(), "toxic")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("vec_id")
    label = F.when(key % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), key, label, "embedding", key % 50 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


def op13_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.main_texts(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_warc_revisits,
        op3_exact_dedup,
        op4_label_propagation_shards,
        op5_benchmark_decontamination,
        op6_token_counts,
        op7_byte_bpe,
        op8_pii_sanitisation,
        op9_minhash_near_dedup,
        op10_toxicity,
        op11_hard_negatives,
        op12_vector_codes,
        op13_html_main_text,
    )
}

#: Whole vectors as integers.
WHOLE = """
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""


def codes_sql(rounds: int = 2) -> str:
    """Rounds of nearest entry and mean, written out, for vectors of 16 parts of 4 places."""

    def nearest(n: int) -> str:
        distance = " + ".join(f"(a.v[{i}] - b.v[{i}]) ** 2" for i in range(1, 5))
        return f"""
            near{n} AS (
                SELECT row, part, arg_min(entry, far * 64 + entry) AS entry, CAST(min(far) AS BIGINT) AS far
                FROM (SELECT a.row, a.part, b.entry, CAST({distance} AS BIGINT) AS far
                      FROM parts a JOIN book{n} b USING (part))
                GROUP BY row, part
            )"""

    def mean(n: int) -> str:
        means = ", ".join(f"CAST(floor(avg(a.v[{i}])) AS BIGINT)" for i in range(1, 5))
        return f"""
            book{n + 1} AS (
                SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
                FROM book{n} b LEFT JOIN (
                    SELECT a.part, c.entry, [{means}] AS v
                    FROM parts a JOIN near{n} c ON a.row = c.row AND a.part = c.part GROUP BY a.part, c.entry
                ) m ON b.part = m.part AND b.entry = m.entry
            )"""

    steps = ",".join(nearest(n) + "," + mean(n) for n in range(rounds))
    return f"""
        WITH whole AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS row FROM ({WHOLE})),
        parts AS (SELECT row, part, v[part * 4 + 1:part * 4 + 4] AS v FROM whole, (SELECT unnest(range(16)) AS part)),
        book0 AS (SELECT part, row AS entry, v FROM parts WHERE row < 64),
        {steps},
        {nearest(rounds)},
        coded AS (
            SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
            FROM near{rounds} GROUP BY row
        ),
        sha AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM whole JOIN coded USING (row), sha
    """


EXPECTED: dict[str, str] = {
    "op11_hard_negatives": f"""
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(v, lambda x: CAST(x AS DOUBLE)) AS v
            FROM ({WHOLE}) WHERE label IS NOT NULL
        ),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
               other_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
    """,
    "op12_vector_codes": codes_sql(),
    # The test pages' own template: one article, its tags without attributes, two character references.
    "op13_html_main_text": r"""
        WITH articles AS (
            SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '\s+', ' ', 'g') AS body
            FROM pages
        ),
        plain AS (
            SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1)>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS body FROM articles
        ),
        decoded AS (
            SELECT page_id, url,
                   list_filter(list_transform(string_split(body, chr(10)),
                       lambda line: trim(regexp_replace(regexp_replace(replace(line, '&quot;', '"'), '&amp;?', '&', 'g'), ' +', ' ', 'g'))),
                       lambda line: line <> '') AS lines
            FROM plain
        )
        SELECT page_id, url, array_to_string(lines, chr(10)) AS text, length(array_to_string(lines, chr(10))) AS n_chars FROM decoded
    """,
    "op2_warc_revisits": """
        WITH headers AS (
            SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ),
        originals AS (
            SELECT payload_digest, max(page_id) AS first_id
            FROM headers WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
               url
        FROM headers LEFT JOIN originals USING (payload_digest)
    """,
    "op3_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id) = 1 AS kept,
               text_sha256
        FROM texts
    """,
}
