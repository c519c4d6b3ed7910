"""Bottom-k sketches of word shingles: resemblance, containment and distinct counts, all as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import ID, TEXT, id_and_text

WORDS, K = 5, 256
_SPACE = r"[\x20\x09-\x0D]+"
_NO_LONGS = "cast(array() as array<bigint>)"


def with_sketch(rows: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``rows`` with ``name``: ascending array of the k lowest 64-bit hashes of the distinct shingles of a text.

    A shingle is five words, words are runs without ASCII white space; a text with fewer words is one shingle, one
    without words has an empty sketch. Every word is hashed once, a shingle is the hash of its words' hashes.
    """
    words = F.array_remove(F.split(text, _SPACE), "")
    rows = rows.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col("_h")
    windows = F.transform(F.sequence(F.lit(0), F.size(h) - WORDS), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WORDS)]))
    # _h is named outside the lambda as well, so that it stays a column and is not made again for every shingle
    found = F.when(F.size(h) >= WORDS, windows).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.expr(_NO_LONGS))
    return rows.withColumn(name, F.slice(F.sort_array(F.array_distinct(found)), 1, k)).drop("_h")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together. Parts of one text must share the words that a shingle can straddle."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both have. Two empty sketches are equal (1), one is unlike any other (0)."""
    both = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(both, a), b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(shared / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the share of the hash range up to the k-th lowest."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: resemblance times the union's size over a's size, 1 at most. An empty a is contained."""
    share = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def fingerprint(a: Column) -> Column:
    """A sketch as a string of 16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _with_bucket(rows: DataFrame, key: str, bounds: list[int]) -> DataFrame:
    """``rows`` with ``_bucket``, the number of ascending ``bounds`` below the key, found in two steps of about sqrt(len(bounds))."""
    if not bounds:
        return rows.withColumn("_bucket", F.lit(0))
    width = int(len(bounds) ** 0.5) + 1
    every = F.lit(bounds[::width])
    rows = rows.withColumn("_coarse", F.size(F.filter(every, lambda b: b < F.col(key))))
    fine = F.slice(F.lit(bounds), (F.col("_coarse") - 1) * width + 1, F.lit(width))
    inside = (F.col("_coarse") - 1) * width + F.size(F.filter(fine, lambda b: b < F.col(key)))
    return rows.withColumn("_bucket", F.when(F.col("_coarse") == 0, F.lit(0)).otherwise(inside)).drop("_coarse")


def with_next(docs: DataFrame, per_partition: int = 4) -> tuple[DataFrame, Column]:
    """Rows (doc_id, text, _bucket, _guest, ...) and a window over which ``lead`` reaches the next row in descending doc_id.

    Documents are dealt into ranges of doc_id, ``per_partition`` for each shuffle partition, and sorted within. The
    first row of the range below also stands, as a guest, at the end of a range, and the very first at the end of the
    last, so the next row is always at hand and texts are shuffled once. Rows with ``_guest`` = 1 are to be left out of results.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs).withColumn("_key", F.coalesce(ID, F.lit(-(2**63))))
    count = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [k / count for k in range(1, count)]
    bounds = rows.select(F.percentile_approx("_key", parts, 10 * count)).first()[0] or []
    rows = _with_bucket(rows, "_key", sorted(set(bounds)))
    # one row per range
    heads = sorted((r["_bucket"], r["head"]) for r in rows.groupBy("_bucket").agg(F.max("_key").alias("head")).collect())
    guests = [(heads[k][0], heads[k - 1][1]) for k in range(len(heads))]
    at = F.broadcast(spark.createDataFrame(guests, "_target int, _head long"))
    visits = rows.join(at, F.col("_key") == F.col("_head")).select(ID, TEXT, "_key", F.col("_target").alias("_bucket"), F.lit(1).alias("_guest"))
    rows = rows.select(ID, TEXT, "_key", "_bucket", F.lit(0).alias("_guest")).union(visits)
    order = Window.partitionBy("_bucket").orderBy("_guest", F.desc("_key"), F.desc(F.xxhash64(TEXT)))
    return rows, order


def edited_fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    document in descending doc_id; after the last comes the first, null ids come last, rows of one id are ordered by a
    hash of their text. Null texts are empty. Repeated rows come back each.
    """
    rows, order = with_next(docs)
    rows = rows.withColumn("_next", F.lead(TEXT).over(order))
    cut = F.floor(F.length(TEXT) / 3).cast("int")
    edited = F.concat(F.substring(TEXT, F.lit(1), F.length(TEXT) - cut), F.substring("_next", F.lit(1), cut))
    # a guest needs its own sketch only
    rows = rows.withColumn("_edited", F.when(F.col("_guest") == 0, edited).otherwise(F.lit(""))).drop("_next")
    rows = with_sketch(with_sketch(rows, TEXT, "_own", k), "_edited", "_other", k)
    rows = rows.withColumn("_near", F.lead("_own").over(order)).where("_guest = 0")
    own, other, near = F.col("_own"), F.col("_other"), F.col("_near")
    return rows.select(
        ID,
        F.length(TEXT).cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"),
        fingerprint(other).alias("edited_fingerprint"),
        resemblance(own, other, k).alias("near_edited"),
        resemblance(own, near, k).alias("near_next"),
    )
