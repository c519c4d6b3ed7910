"""The registered queries of this subpackage, each over its whole table, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.alignment import alignment_digests
from lakeops.llm.automaton import round_trip_digests
from lakeops.llm.bitplanes import read_digests, write_ids
from lakeops.llm.common import table, temporary_path
from lakeops.llm.decontaminate import contaminated
from lakeops.llm.jaccard import jaccard_groups
from lakeops.llm.licenses import license_labels
from lakeops.llm.pieces import encode_pieces
from lakeops.llm.pii import personal_data
from lakeops.llm.quality import KEEP_AT, graded_scores, three_grades, train
from lakeops.llm.sketches import edited_fingerprints
from lakeops.llm.token_counts import token_counts
from lakeops.llm.vector_codes import vector_codes
from lakeops.llm.warc import derivatives, response_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op5_ngram_jaccard_join",
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
      FROM w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS t(i)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
    r(doc_id, root) AS (
      SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id)
    SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id
    FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
    """,
)
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_benchmark_decontamination")
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "question_cover", "answer_cover")


@query("op3_token_id_planes")
def op3_token_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = temporary_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_digests(spark, path)


@query("op4_warc_derivatives")
def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(response_records(table(spark, sf_dir, "pages")))
    return made.select("page_id", "kind", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "n_bytes")


@query("op6_bottom_k_sketch")
def op6_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_pieces", "ids_crc32", "n_decoded", "round_trip")


@query("op8_personal_data")
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, three_grades(table(spark, sf_dir, "labels")), 3)
    return graded_scores(docs, model).withColumn("keep", F.col("top_tail") >= KEEP_AT)


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))


def _op11_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Vectors and entries as lists of doubles, whole numbers below 2**53; the nearest entry by the smallest (distance, index)."""
    nearest = """
    a{r} AS MATERIALIZED (
      SELECT p.i, p.part, arg_min(b.entry, {{'d': list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v), 'e': b.entry}}) AS entry,
             min(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v) + list_inner_product(b.v, b.v)) AS d
      FROM p JOIN b{r} b USING (part) GROUP BY p.i, p.part)"""
    means = """
    m{n} AS (
      SELECT part, entry, list(m ORDER BY pos) AS v FROM (
        SELECT a.part, a.entry, u.pos, floor(sum(p.v[u.pos]) / count(*)) AS m
        FROM a{r} a JOIN p USING (i, part), unnest(range(1, len(p.v) + 1)) AS u(pos) GROUP BY ALL) GROUP BY part, entry),
    b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{n} m USING (part, entry))"""
    steps = []
    for r in range(rounds):
        steps += [nearest.format(r=r), means.format(r=r, n=r + 1)]
    steps.append(nearest.format(r=rounds))
    return f"""
    WITH k AS (
      SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i, vec_id, label,
             list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (
      SELECT i, q AS part, v[q * len(v) // {parts} + 1 : (q + 1) * len(v) // {parts}] AS v FROM k, unnest(range({parts})) AS t(q)),
    b0 AS MATERIALIZED (SELECT part, i - 1 AS entry, v FROM p WHERE i <= {entries}),
    {",".join(steps)},
    f AS (SELECT i, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY i),
    h AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS digest FROM b{rounds})
    SELECT k.vec_id, f.code, f.error, sum(f.error) OVER (PARTITION BY k.label)::BIGINT AS label_error, h.digest AS codebooks_sha256
    FROM k JOIN f USING (i), h
    """


@query("op11_vector_codes", _op11_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings")).drop("label")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_merge_automaton")
def op13_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
