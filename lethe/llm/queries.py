"""One query per operator over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.llm.chat import repair_conversations
from lethe.llm.decontam import contained_items
from lethe.llm.fill_middle import fill_in_middle, restored
from lethe.llm.hyperminhash import near_duplicates
from lethe.llm.html_extract import extract_main_text
from lethe.llm.lexical import ranked_documents
from lethe.llm.licence_scan import find_licences
from lethe.llm.mixing import mix_sources
from lethe.llm.packing import pack, token_pieces
from lethe.llm.quality import quality_scores
from lethe.llm.records import new_folder, read_records, record_positions, write_records
from lethe.llm.words import bounded_batches
from lethe.llm.token_counts import token_counts
from lethe.llm.vectors import near_vectors
from lethe.session import prepare, shared_folder

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op3_consensus_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_length_delimited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, shared_folder(spark))
    manifest = write_records(docs, folder, public_tokenizers.path(WORD_VOCABULARY))
    placed = record_positions(read_records(manifest), manifest)
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_VOCABULARY)
    )


def op7_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = pack(token_pieces(docs, public_tokenizers.path(WORD_VOCABULARY)))
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op8_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licences(table(spark, sf_dir, "documents"))


def op9_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_wavelet_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    sha256 = lambda text: F.sha2(text.cast("binary"), 256)
    output = F.col("output")
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha256(output).alias("output_sha256"),
        sha256(restored(output, F.col("form"))).alias("restored_sha256"),
    )


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_automaton_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_cotraining,
        op2_role_repair,
        op3_consensus_paths,
        op4_sorted_projections,
        op5_length_delimited_records,
        op6_pretoken_counts,
        op7_residual_packing,
        op8_licence_classifier,
        op9_containment_search,
        op10_hyperminhash,
        op11_wavelet_fill,
        op12_source_mix,
        op13_automaton_search,
        pipeline,
    )
}

ORACLE = {
    "op9_containment_search": r"""
        WITH words AS (
            SELECT 0 AS kind, doc_id AS id, list_filter(regexp_split_to_array(lower(text),
                '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
            FROM documents WHERE doc_id IS NOT NULL
            UNION ALL
            SELECT 1, item_id, list_filter(regexp_split_to_array(lower(text),
                '[ \t\n\x0B\f\r]+'), lambda x: x <> '')
            FROM benchmark WHERE item_id IS NOT NULL
        ), shingles AS (
            SELECT DISTINCT kind, id, unnest(CASE
                WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                    lambda i: array_to_string(w[i:i + 4], ' '))
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
                ELSE [] END) AS s
            FROM words
        ), sizes AS (
            SELECT id, count(*) AS n FROM shingles WHERE kind = 1 GROUP BY id
        )
        SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS item_shingles,
               count(*) AS matched, count(*) / any_value(n) AS containment
        FROM shingles d JOIN shingles i ON d.s = i.s AND d.kind = 0 AND i.kind = 1
        JOIN sizes ON sizes.id = i.id
        GROUP BY d.id, i.id
        HAVING count(*) * 100 >= any_value(n) * 75
    """,
    "op11_wavelet_fill": r"""
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
            FROM documents
        ), numbered AS (
            SELECT doc_id, text, CAST('0x' || digest[1:8] AS BIGINT) AS h1,
                   CAST('0x' || digest[9:16] AS BIGINT) AS h2, CAST('0x' || digest[17:24] AS BIGINT) AS h3,
                   CAST('0x' || digest[25:32] AS BIGINT) AS h4,
                   regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units
            FROM drawn
        ), cut AS (
            SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
                   greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM numbered
        ), parts AS (
            SELECT *, array_to_string(units[1:a], '') AS prefix,
                   array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
            FROM cut
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts
    """,
    "op12_source_mix": r"""
        WITH split AS (
            SELECT doc_id, source, list_filter(regexp_split_to_array(coalesce(text, ''),
                '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
            FROM documents
        ), docs AS (
            SELECT doc_id, source, len(w) AS size,
                   CASE WHEN len(w) > 0 THEN greatest(0.05::DOUBLE,
                        len(list_filter(w, lambda x: regexp_matches(x, '^\p{L}+[.,;:!?]?$'))) / len(w))
                        ELSE 1.0::DOUBLE END AS weight,
                   (CAST('0x' || md5('12:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:13] AS BIGINT)
                    + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
            FROM split
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM docs GROUP BY source
        ), levels AS (
            SELECT *, ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE
                       - coalesce(sum(2 * source_size) OVER ahead, 0)) / sum(weight) OVER behind AS level
            FROM sources
            WINDOW ahead AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   behind AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), targets AS (
            SELECT source, source_size,
                   least((2 * source_size)::DOUBLE, weight * (SELECT level FROM levels
                        WHERE 2 * source_size / weight >= level
                        ORDER BY 2 * source_size / weight, source NULLS LAST LIMIT 1)) AS target
            FROM levels
        ), placed AS (
            SELECT d.*, source_size, target,
                   CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2)::BIGINT
                        ELSE 0 END AS epochs,
                   coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / d.weight, doc_id, size
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (size * (epochs + CASE WHEN before * 2 + size <= (target - epochs * source_size) * 2
                        THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM placed
    """,
    "op13_automaton_search": r"""
        WITH texts AS (
            SELECT 0 AS kind, doc_id AS id, text FROM documents
            UNION ALL
            SELECT 1, item_id, text FROM benchmark WHERE item_id IS NOT NULL
        ), terms AS (
            SELECT kind, id, row_number() OVER () AS doc, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM texts
        ), sizes AS (
            SELECT doc, id, len(t) AS n, t FROM terms WHERE kind = 0 AND len(t) > 0
        ), figures AS (
            SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM sizes
        ), asked AS (
            SELECT DISTINCT id AS item_id, unnest(t) AS term FROM terms WHERE kind = 1
        ), counted AS (
            SELECT doc, id, n, term, count(*) AS tf
            FROM (SELECT doc, id, n, unnest(t) AS term FROM sizes) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM counted, figures GROUP BY term
        ), scored AS (
            SELECT item_id, doc, c.id AS doc_id, sum(w * ((1000000000 * tf) //
                   (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l)))))::BIGINT AS score
            FROM asked JOIN counted c USING (term) JOIN weights USING (term), figures
            WHERE c.id IS NOT NULL
            GROUP BY item_id, doc, c.id
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
               doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 10
    """,
}
