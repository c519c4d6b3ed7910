"""Each stage of the corpus pipeline, and run(), against plain code on awkward rows."""

import collections
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
import sentencepiece
from lakeops.llm import pii
from lakeops.llm.quality import KEEP_AT, score_column, three_grades, train

SF = "/root/testdata/sf0.001"
WORDS = "amber birch cedar delta ember fjord grove heath islet jetty knoll larch marsh north ocean plain quarry ridge shore tundra".split()


def prose(seed, n=60):
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed + k) % 13) for k in range(n))


#: doc_id, text, lang, source, n_chars: nulls, empty texts, repeated rows, ids with several texts, copies and near copies.
ROWS = [
    (1, prose(1), "en", "web", None),
    (2, prose(1), "en", "web", 5),
    (3, prose(1, 59) + " other", "en", "hot", 6),
    (3, prose(3), "en", "hot", 6),
    (4, None, "en", "web", 0),
    (5, "", None, None, 0),
    (5, "", None, None, 0),
    (6, "  ", "de", "web", 2),
    (None, prose(6), "fr", "web", 1),
    (None, prose(6), "fr", "web", 1),
    (7, prose(7) + " mail a.b@example.org or +1 (337) 555-7349 now", "en", "web", 9),
    (8, "café ☕ 漢字 " + prose(8), "fr", "web", 9),
    (9, prose(6) + " tail", "fr", "web", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.select("*", *[F.lit(k).alias(k) for k in ("id", "h", "row", "s", "rank", "_spans", "_text", "group_key")])


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def counted(frame, *columns):
    plain = lambda v: tuple(v) if isinstance(v, list) else v
    return collections.Counter(tuple(map(plain, r)) for r in frame.select(*columns).collect())


def same_columns(frame, docs):
    return frame.columns == docs.columns and [f.dataType for f in frame.schema.fields] == [f.dataType for f in docs.schema.fields]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near_duplicates(rows):
    """One row of each group: the lowest id (null last); of equal rows one stays."""
    rows = list(dict.fromkeys(rows))
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    kept = collections.Counter()
    best = {}
    for k, r in enumerate(rows):
        if not sets[k]:
            kept[r] += 1
        elif group[k] not in best or (r[0] is None, r[0] or 0) < (best[group[k]][0] is None, best[group[k]][0] or 0):
            best[group[k]] = r
    return kept + collections.Counter(best.values())


def test_near_duplicates_against_plain_code(spark, docs, none):
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert same_columns(got, docs)
    assert counted(got, "doc_id", "text", "lang", "source", "n_chars") == plain_near_duplicates(ROWS)
    assert corpus_pipeline.near_duplicates(spark, none, SF).count() == 0


def test_quality_keeps_rows_by_their_text_alone(spark, docs, none):
    got = corpus_pipeline.quality(spark, docs, SF)
    assert same_columns(got, docs)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = train(docs, three_grades(labels), 3)
    scored = docs.withColumn("score", score_column(spark, model, F.coalesce("text", F.lit(""))))
    want = collections.Counter((r["doc_id"], r["text"]) for r in scored.collect() if r["score"]["top_tail"] >= KEEP_AT)
    assert counted(got, "doc_id", "text") == want
    assert corpus_pipeline.quality(spark, none, SF).count() == 0


def test_decontamination_drops_the_rows_with_items(spark, docs, none):
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").collect()]
    item = max(items, key=lambda t: len(t.split()))
    dirty = spark.createDataFrame([(50, prose(50) + " " + item + " " + prose(51), "en", "web", 1), (3, item, "en", "web", 1), (None, item, "en", "web", 1)], SCHEMA)
    rows = docs.unionByName(dirty.select("*", *[F.lit(k).alias(k) for k in docs.columns[5:]]))
    got = corpus_pipeline.decontamination(spark, rows, SF)
    assert same_columns(got, docs)
    assert counted(got, "doc_id", "text") == collections.Counter((r[0], r[1]) for r in ROWS)
    assert corpus_pipeline.decontamination(spark, none, SF).count() == 0


def test_personal_data_is_masked_and_counted_anew(spark, docs, none):
    got = corpus_pipeline.personal_data(spark, docs, SF)
    assert same_columns(got, docs)
    rows = {(r["doc_id"], r["text"], r["n_chars"]) for r in got.collect()}
    (masked,) = [r for r in rows if r[0] == 7]
    assert "example.org" not in masked[1] and "7349" not in masked[1] and masked[1].startswith(prose(7)) and masked[2] == len(masked[1])
    assert counted(got.where("doc_id is null or doc_id <> 7"), "doc_id", "text", "n_chars") == collections.Counter((r[0], r[1], r[4]) for r in ROWS if r[0] != 7)
    assert corpus_pipeline.personal_data(spark, none, SF).count() == 0
    assert pii.fit_classifier(none) is not None


def plain_ids(text):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return tuple(model.encode(text or ""))


def test_pieces_are_the_librarys(spark, docs, none):
    got = counted(corpus_pipeline.pieces(spark, docs, SF), "doc_id", "ids")
    assert got == collections.Counter((r[0], plain_ids(r[1])) for r in ROWS)
    assert corpus_pipeline.pieces(spark, none, SF).count() == 0


def test_run_is_its_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert counted(corpus_pipeline.run(spark, SF), "doc_id", "ids_crc32") == counted(docs, "doc_id", "ids_crc32")
    assert 0 < docs.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
