"""N-gram Jaccard join as a blocked sparse matrix product, and the groups of documents it links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lakeops.llm.common import ID, TEXT, Landings, id_and_text, temporary_table
from lakeops.llm.components import components

WORDS, PERCENT = 5, 80
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Size of the list of frequent shingles and of the bit table below. They bound what is broadcast; no result depends on them.
FREQUENT, BITS = 1 << 18, 1 << 24
_CHUNK, _SEEN_AT = 4_000_000, 3
#: Rounds end with one that joins no more components than this part of the first one's; no result depends on it.
LAST = 16
#: Bands of a set and least hashes in each; sets that agree on a band are tried first. No result depends on them.
BANDS, ROWS = 16, 4
#: Percent of a set by which its prefix is longer than needed to meet a partner, so that partners must share as many columns.
EXTRA = 5


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


_FACTORS = _mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _MIX) | np.uint64(1)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text.

    A-Z are lower-cased, words are runs without ASCII white space; a text with fewer words has its whole sequence as its
    only shingle, one without words none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, found), np.uint64, n)
    width = min(words, n)
    total = h[: n - width + 1].copy()
    for k in range(1, width):
        total = _mixed(total) + h[k : n - width + 1 + k]
    return np.unique(_mixed(total + np.uint64(width)))


def signature(hashes: np.ndarray) -> int:
    """A 64-bit key of a shingle set: documents with equal sets form one class."""
    total = hashes.sum(keepdims=True) + _mixed(np.bitwise_xor.reduce(_mixed(hashes), keepdims=True)) + np.uint64(len(hashes))
    return int(_mixed(total).view(np.int64)[0])


def _least_overlap(a, b, percent: int):
    """Smallest intersection of sets of sizes a and b with 100 * intersection >= percent * union, as a column."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def _profile(frames: Iterator[pd.DataFrame], words: int) -> Iterator[pd.DataFrame]:
    """A row per document (h null), and rows (h, n) of shingles that many documents of a stretch hold."""
    waiting, held = [], 0

    def counted() -> pd.DataFrame:
        values, n = np.unique(np.concatenate(waiting), return_counts=True)
        often = np.flatnonzero(n >= _SEEN_AT)
        often = often[np.argsort(n[often])[::-1][: FREQUENT // 8]]
        none = pd.array([None] * len(often), "Int64")
        return pd.DataFrame({"doc_id": none, "text_key": none, "n": n[often], "sig": 0, "h": values[often].view(np.int64)})

    for frame in frames:
        n, sig = [], []
        for text in frame[TEXT]:
            hashes = shingle_hashes(text, words)
            n.append(len(hashes))
            sig.append(signature(hashes) if len(hashes) else 0)
            waiting.append(hashes)
            held += len(hashes)
            if held > _CHUNK:
                yield counted()
                waiting, held = [], 0
        yield pd.DataFrame({"doc_id": frame[ID].astype("Int64"), "text_key": frame["text_key"].astype("Int64"), "n": n, "sig": sig, "h": pd.array([None] * len(n), "Int64")})
    if held:
        yield counted()


class _Order:
    """One order of all shingles: rare ones by hash, then the listed frequent ones from rare to frequent.

    Any order gives whole results as long as all documents use the same; putting frequent shingles last keeps shared
    passages and headers out of the prefixes.
    """

    def __init__(self, hashes: np.ndarray):
        values = np.array(hashes, np.int64).view(np.uint64)
        by = np.argsort(values)
        self.values, self.rank = values[by], by

    def arrange(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.values):
            return hashes
        at = np.minimum(np.searchsorted(self.values, hashes), len(self.values) - 1)
        listed = self.values[at] == hashes
        late = np.flatnonzero(listed)
        return np.concatenate([hashes[~listed], hashes[late[np.argsort(self.rank[at[late]])]]])


def _prefixes(frames: Iterator[pd.DataFrame], words: int, percent: int, order) -> Iterator[pd.DataFrame]:
    seen: set[int] = set()  # classes of this task; one copy stands for all
    order = order.value
    for frame in frames:
        out = []
        for text in frame[TEXT]:
            hashes = shingle_hashes(text, words)
            n = len(hashes)
            if not n or (sig := signature(hashes)) in seen:
                continue
            seen.add(sig)
            prefix = order.arrange(hashes)[: n - (percent * n + 99) // 100 + 1 + EXTRA * n // 100]
            out.append((prefix, sig, n))
        if out:
            sizes = [len(p) for p, _, _ in out]
            yield pd.DataFrame(
                {
                    "h": np.concatenate([p for p, _, _ in out]).view(np.int64),
                    "sig": np.repeat([s for _, s, _ in out], sizes),
                    "n": np.repeat(np.array([n for _, _, n in out], np.int32), sizes),
                    "pos": np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]),
                }
            )


def _bands(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set's bands, and places in them; two sets agree on a band with a chance of their similarity to the power ROWS.

    Places are short forms of the next band's least hashes, so that sets that agree on those too lie side by side.
    """
    least = np.array([(hashes * factor).min() for factor in _FACTORS], np.uint64).reshape(BANDS, ROWS)
    keys, places = np.arange(BANDS, dtype=np.uint64), np.zeros(BANDS, np.uint64)
    short = np.uint64(64 // ROWS)
    for k in range(ROWS):
        keys = _mixed(keys + least[:, k])
        places = (places << short) | (_mixed(least[:, k]) >> (np.uint64(64) - short))
    return keys.view(np.int64), np.roll(places, -1).view(np.int64)


def _sets(frames: Iterator[pd.DataFrame], words: int, wanted) -> Iterator[pd.DataFrame]:
    seen: set[int] = set()
    bits = np.frombuffer(wanted.value, np.uint8)
    for frame in frames:
        bit = frame["text_key"].to_numpy(np.int64) % BITS
        found = (bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
        sigs, sets, bands = [], [], []
        for text in frame[TEXT][found]:
            hashes = shingle_hashes(text, words)
            if len(hashes) and (sig := signature(hashes)) not in seen:
                seen.add(sig)
                sigs.append(sig)
                sets.append(hashes.view(np.int64))
                bands.append(_bands(hashes))
        if sigs:
            yield pd.DataFrame({"sig": sigs, "n": [len(s) for s in sets], "s": sets, "bands": [k for k, _ in bands], "places": [p for _, p in bands]})


def _bit_table(df: DataFrame, column: str) -> bytes:
    """A Bloom-like table of BITS bits of a column's values; its size does not depend on theirs."""
    bit = df.select((F.pmod(F.col(column), F.lit(BITS)) + 1).alias("bit"))
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    table = bytearray(BITS // 8)
    for row in parts.collect():
        at = (row["bucket"] - 1) * 4096
        chunk = bytes(row["bits"])
        table[at : at + len(chunk)] = chunk
    return bytes(table)


def _prefix(n, percent: int):
    """Columns of a set's prefix when it is the larger of a pair."""
    return n - F.ceil(n * F.lit(percent) / F.lit(100)) + 1 + F.floor(n * F.lit(EXTRA) / F.lit(100))


def _index_prefix(n, percent: int):
    """Columns of a set's prefix when it is the smaller of a pair, which needs fewer."""
    return n - F.ceil(n * F.lit(2 * percent) / F.lit(100 + percent)) + 1 + F.floor(n * F.lit(EXTRA) / F.lit(100))


def _candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """Sums up the products of the column blocks by pair and drops pairs whose sizes rule a link out.

    ``pairs`` has a row for each prefix column that a pair shares: a the smaller set, pa and pb its places there. Of
    what the pair shares besides, all lies behind the prefix of one of the two: the one whose prefix ends first.
    """
    pairs = pairs.where(F.col("pa") < _index_prefix(F.col("na"), percent))
    least = _least_overlap(F.col("na"), F.col("nb"), percent)
    summed = pairs.where(F.col("na") * 100 >= F.col("nb") * percent).groupBy("a", "b", "na", "nb")
    summed = summed.agg(F.count("*").alias("shared"), F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    behind = F.greatest(F.col("na") - _index_prefix(F.col("na"), percent), F.col("nb") - _prefix(F.col("nb"), percent))
    return summed.where((rest >= least) & (F.col("shared") + behind >= least)).select("a", "b", "na", "nb", "shared")


def _best(found: DataFrame, *of: str) -> DataFrame:
    """Of the pairs of each larger set (and each of ``of``) the one that shares most bands."""
    found = found.groupBy("b", "nb", *of).agg(F.max(F.struct("shared", "a", "na")).alias("x"))
    return found.select("x.a", "b", "x.na", "nb")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose whole sets reach the similarity."""
    both = pairs.join(sets.select(F.col("sig").alias("a"), F.col("s").alias("sa")), "a")
    both = both.join(sets.select(F.col("sig").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(shared * 100 >= (F.col("na") + F.col("nb") - shared) * percent).select("a", "b")


class _Components:
    """The component of every set that has a link, the lowest key of its members; joined on as links between components are found."""

    def __init__(self, spark, work: Landings):
        self.work, self.of, self.round = work, spark.createDataFrame([], "sig long, c long"), 0

    def known(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with the component of a key; a set without links is one of its own."""
        of = self.of.select(F.col("sig").alias(key), F.col("c").alias(name))
        return rows.join(of, key, "left").withColumn(name, F.coalesce(name, key))

    def link(self, links: DataFrame) -> int:
        """Take up links (a, b), one for each two components, and tell how many there were."""
        self.round += 1
        ends = self.known(self.known(links, "a", "ca"), "b", "cb").where("ca <> cb")
        edges = self.work.keep(ends.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), f"edges-{self.round}")
        found = edges.count()
        if not found:
            return 0
        roots = components(edges, "a", "b", f"jaccard-{self.round}")
        moved = self.of.join(roots, F.col("c") == F.col("node"), "left").select("sig", F.coalesce("root", "c").alias("c"))
        fresh = roots.join(self.of, F.col("node") == F.col("sig"), "left_anti").select(F.col("node").alias("sig"), F.col("root").alias("c"))
        self.of = self.work.keep(moved.union(fresh), f"components-{self.round}")
        return found


def _neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of each set of a band with the first one and the nearest one before it, where these are of another component.

    Rows a, b, na, nb, ca, shared: a the smaller set (ties: the lower key), ca its component, shared the bands that both agree on.
    """
    band = Window.partitionBy("h").orderBy("place", "n", "sig")
    upto = band.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.struct("sig", "n", "c", "bands")
    rows = rows.withColumn("head", F.first(start).over(upto)).withColumn("prior", F.lag(start).over(band))
    begins = F.col("prior.c") != F.col("c")
    rows = rows.withColumn("other", F.last(F.when(begins, F.col("prior")), ignorenulls=True).over(upto))
    partners = F.array_distinct(F.filter(F.array("head", "other"), lambda o: o["c"] != F.col("c")))
    rows = rows.select("sig", "n", "c", "bands", F.explode(partners).alias("o"))
    first = (F.col("o.n") < F.col("n")) | ((F.col("o.n") == F.col("n")) & (F.col("o.sig") < F.col("sig")))
    pick = lambda p, q: F.when(first, F.col(p)).otherwise(F.col(q))
    ends = [pick(p, q).alias(k) for k, p, q in (("a", "o.sig", "sig"), ("b", "sig", "o.sig"), ("na", "o.n", "n"), ("nb", "n", "o.n"), ("ca", "o.c", "c"))]
    rows = rows.select(*ends, F.size(F.array_intersect("bands", "o.bands")).alias("shared"))
    return rows.where(F.col("na") * 100 >= F.col("nb") * percent)


def _shared(incidence: DataFrame, percent: int) -> DataFrame:
    """The rows of columns where another set's size allows a link."""
    column = Window.partitionBy("h").orderBy("n", "sig")
    near = incidence.withColumn("before", F.lag("n").over(column)).withColumn("after", F.lead("n").over(column))
    return near.where((F.col("before") * 100 >= F.col("n") * percent) | (F.col("n") * 100 >= F.col("after") * percent)).select("h", "sig", "n", "pos")


def _enough(shared: DataFrame) -> DataFrame:
    """The sets that share enough columns of their prefix to have a link.

    Of two sets that link, all that they share lies in both prefixes but for what is behind the one that ends first. That
    set's prefix ends EXTRA percent later than needed to meet the other, so they share at least as many columns.
    """
    counted = shared.groupBy("sig", "n").agg(F.count("*").alias("k"))
    return counted.where(F.col("k") >= F.floor(F.col("n") * F.lit(EXTRA) / F.lit(100))).select("sig")


def _mixed_columns(rows: DataFrame) -> DataFrame:
    """The rows (h, c, ...) of columns that hold several components."""
    mixed = rows.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("h")
    return rows.join(mixed, "h", "left_semi")


def _within_reach(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``open_`` with w, how many of a set's shingles sets of other components hold, for sets where these are enough for a link.

    No set of another component shares more than w with it. Any that could link is in ``open_`` too, so its shingles count.
    """
    of = open_.select("sig", "c").distinct()
    held = sets.join(of, "sig").select("sig", "n", "c", F.explode("s").alias("h"))
    column = Window.partitionBy("h")
    held = held.withColumn("low", F.min("c").over(column)).withColumn("high", F.max("c").over(column)).where("low < high")
    reach = held.groupBy("sig", "n").agg(F.count("*").alias("w")).where(F.col("w") * 100 >= F.col("n") * percent)
    return open_.join(reach.select("sig", "w"), "sig")


def _across(open_: DataFrame, percent: int) -> DataFrame:
    """A row for each column that two sets of different components share, where size and reach of both allow a link."""
    a, b = (open_.select("h", *[F.col(c).alias(f"{c}_{s}") for c in ("sig", "n", "pos", "c", "w")]) for s in "ab")
    rest = a.where(F.col("pos_a") < _index_prefix(F.col("n_a"), percent)).join(b, "h").where(
        ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("sig_a") < F.col("sig_b"))))
        & (F.col("c_a") != F.col("c_b"))
        & (F.col("n_a") * 100 >= F.col("n_b") * percent)
        & (F.least("w_a", "w_b") >= _least_overlap(F.col("n_a"), F.col("n_b"), percent))
    )
    return rest.select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b"), F.col("n_a").alias("na"), F.col("n_b").alias("nb"), F.col("pos_a").alias("pa"), F.col("pos_b").alias("pb"))


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the lowest doc_id its links reach, itself included), text_key, group_key.

    ``text_key`` is xxhash64 of the text, ``group_key`` the same for all rows of a group and null for texts without words.

    Two documents link when 100 * |A and B| >= percent * |A or B| over their sets of distinct word shingles. The
    incidence matrix of classes of equal sets by shingles is kept in coordinate form and dealt by column; each block
    multiplies its columns, and the overlap counts of a pair are added up over the blocks, in the task that makes them first. Only the columns of
    a set's prefix in one global order are needed to meet every pair that can reach the similarity; sizes and
    positions drop the pairs that cannot, and the rest is decided on the whole sets.

    Pairs inside one large group are not all made. Sets that share too few columns of their prefix to have a link leave first, and only the texts of the
    others are read again for their whole sets. Rounds then join components by links that are likely: sets that agree on a band of
    least hashes are put in an order, each meets the first one and the nearest one before it that are of another component, and the best pair of each set
    (from the second round on with each such component) that has not been tried is decided on the whole sets.
    What the rounds have missed comes from the product of the columns that still hold several components, over the sets of which so much lies in sets of
    other components that a link is left to find; it is exact whatever the rounds have found.

    Null and empty texts have no shingles and form a group of their own each; null ids get the lowest id of their
    group, if any; repeated rows are copies. Keys of sets and shingles are 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs)
    keyed = rows.withColumn("text_key", F.xxhash64(TEXT))
    profile = temporary_table(keyed.mapInPandas(lambda f: _profile(f, words), "doc_id long, text_key long, n int, sig long, h long"), "jaccard-profile")
    often = profile.where("h is not null").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT)
    order = spark.sparkContext.broadcast(_Order(often.select("h").toPandas()["h"].to_numpy()[::-1]))

    work = Landings("jaccard-work")
    texts = rows.select(TEXT)
    incidence = texts.mapInPandas(lambda f: _prefixes(f, words, percent, order), "h long, sig long, n int, pos int")
    incidence = incidence.repartition("h").dropDuplicates(["h", "sig"])
    shared = work.keep(_shared(incidence, percent), "shared")
    enough = work.keep(_enough(shared), "enough")

    keys = profile.where("h is null").join(enough, "sig", "left_semi").groupBy("sig").agg(F.min("text_key").alias("text_key"))
    wanted = spark.sparkContext.broadcast(_bit_table(keys, "text_key"))
    sets = keyed.select("text_key", TEXT).mapInPandas(lambda f: _sets(f, words, wanted), "sig long, n int, s array<long>, bands array<long>, places array<long>")
    sets = work.keep(sets.groupBy("sig").agg(*[F.first(c).alias(c) for c in ("n", "s", "bands", "places")]), "sets")
    group, tried, number, first = _Components(spark, work), None, 0, 0
    bands = sets.select("sig", "n", "bands", F.explode(F.arrays_zip("bands", "places")).alias("x"))
    bands = bands.select("sig", "n", "bands", F.col("x.bands").alias("h"), F.col("x.places").alias("place"))
    while True:
        # bands of one component have nothing to give any more, and stay so
        bands = work.keep(_mixed_columns(group.known(bands.drop("c"), "sig", "c")), f"bands-{number}")
        pairs = _neighbours(bands, percent)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        # at first each set is a component, and one partner each joins most of them
        pairs = work.keep(_best(pairs, *["ca"] * (number > 0)), f"pairs-{number}")
        done = pairs.select("a", "b")
        tried = done if tried is None else tried.union(done)
        number += 1
        found = group.link(work.keep(_linked(pairs, sets, percent), f"links-{number}"))
        first = first or found
        if found * LAST <= first:
            # what is left is found in any case; a round that joins little costs more than it saves
            break

    open_ = work.keep(_mixed_columns(group.known(shared.join(enough, "sig", "left_semi"), "sig", "c")), "open")
    open_ = work.keep(_within_reach(open_, sets, percent), "reach")
    late = work.keep(_candidates(_across(open_, percent), percent).join(tried, ["a", "b"], "left_anti"), "late")
    group.link(work.keep(_linked(late, sets, percent), "late-links"))
    group = temporary_table(group.of.select(F.col("sig").alias("node"), F.col("c").alias("root")), "jaccard-components")
    work.drop_all()

    of = profile.where("h is null").select(ID, "text_key", F.col("n").alias("n_shingles"), "sig")
    of = of.join(group.select(F.col("node").alias("sig"), "root"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    lowest = of.where("n_shingles > 0").groupBy("root").agg(F.min(ID).alias("lowest"))
    own = F.when(F.col("n_shingles") == 0, F.col(ID)).otherwise(F.col("lowest"))
    return of.join(lowest, "root", "left").select(ID, F.col("n_shingles").cast("long").alias("n_shingles"), own.alias("component_id"), "text_key", F.when(F.col("n_shingles") > 0, F.col("root")).alias("group_key"))
