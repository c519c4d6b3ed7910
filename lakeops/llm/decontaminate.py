"""Benchmark decontamination: a BM25 index of test items searched by every passage with block-max bounds."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import ID, TEXT, batches, id_and_text, temporary_table

#: Words of a passage, words between passage starts, longest stretch of an item that is one entry of the index.
PASSAGE, STEP, STRETCH = 64, 32, 48
#: A passage retrieves an entry when its BM25 score is at least this share of the entry's score for itself.
THRESHOLD = 0.55
#: Word n-grams by which an item is verified, and the share of those of its question and of its answer that must be there.
GRAM, COVER = 3, 0.6
#: Entries of the index that are searched at once and entries of a block; they bound what is broadcast.
ENTRIES, BLOCK = 1_024, 16
K1, B = 1.2, 0.75
_GAPS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def item_words(text: str) -> list[bytes]:
    """Lower-cased words; ASCII characters other than letters and digits separate them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_GAPS).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """An item's words up to its last sentence, and those of that sentence; with one sentence, its first two thirds and the rest."""
    lines = [s for s in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if item_words(s)]
    if len(lines) > 1:
        return item_words(".".join(lines[:-1])), item_words(lines[-1])
    words = item_words(text)
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


@dataclass
class Index:
    """An inverted index of item stretches: for each term the blocks and entries that hold it, with impacts.

    An impact is the term's BM25 weight in the entry divided by the entry's score for itself, so one threshold serves
    entries of any length. ``bound`` has each term's greatest impact in each block.
    """

    terms: dict[bytes, int]
    bound: np.ndarray
    postings: list[dict[int, tuple[np.ndarray, np.ndarray]]]
    item: np.ndarray
    texts: dict[int, tuple[list[bytes], list[bytes]]]


def build_index(entries: list[tuple[int, list[bytes]]], texts: dict, idf: dict[bytes, float], average: float) -> Index:
    # entries with the same rarest words stand in one block, so bounds of other blocks stay low
    entries = sorted(entries, key=lambda e: (sorted(set(e[1]), key=lambda w: (idf[w], w))[:3], e[0]))
    held: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
    for k, (_, words) in enumerate(entries):
        norm = K1 * (1 - B + B * len(words) / average)
        weight = {w: idf[w] * f * (K1 + 1) / (f + norm) for w, f in Counter(words).items()}
        total = sum(weight.values()) or 1.0
        for w, x in weight.items():
            held[w].append((k, x / total))
    terms = {w: k + 1 for k, w in enumerate(held)}
    bound = np.zeros((len(terms) + 1, max(1, -(-len(entries) // BLOCK))), np.float32)
    postings: list[dict] = [{}]
    for w, k in terms.items():
        blocks = defaultdict(list)
        for at, x in held[w]:
            blocks[at // BLOCK].append((at % BLOCK, x))
        postings.append({b: (np.array([p for p, _ in ps]), np.array([x for _, x in ps])) for b, ps in blocks.items()})
        for b, (_, x) in postings[-1].items():
            bound[k, b] = x.max() * 1.000001
    return Index(terms, bound, postings, np.array([i for i, _ in entries], np.int64), texts)


def search(words: list[bytes], index: Index, threshold: float, passage: int = PASSAGE, step: int = STEP) -> list[tuple[int, int, float]]:
    """(passage start, entry, score) of all entries at or above the threshold, over every passage of a text.

    As in block-max WAND, an entry is only scored when the greatest impacts that its block could give the passage's
    terms reach the threshold; here a block is the pivot and running sums give its bound for all passages of the text
    at once. Blocks below it are passed over whole.
    """
    get = index.terms.get
    terms = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
    if not terms.any():
        return []
    total = np.zeros((len(terms) + 1, index.bound.shape[1]), np.float64)
    np.cumsum(index.bound[terms], axis=0, out=total[1:])
    starts = np.arange(0, max(1, len(terms) - passage + step), step)
    ends = np.minimum(starts + passage, len(terms))
    found = []
    for p, block in zip(*np.nonzero(total[ends] - total[starts] >= threshold - 1e-6)):
        score = np.zeros(BLOCK)
        for t in set(terms[starts[p] : ends[p]].tolist()):
            if (hit := index.postings[t].get(block)) is not None:
                score[hit[0]] += hit[1]
        for at in np.flatnonzero(score >= threshold):
            found.append((int(starts[p]), int(block) * BLOCK + int(at), float(score[at])))
    return found


def _grams(words: list[bytes], n: int) -> set[bytes]:
    return {b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)}


def _cover(part: list[bytes], around: list[bytes]) -> float:
    """Share of the n-grams of a question or answer found around a passage; a shorter part is one n-gram, an empty one is there."""
    n = min(GRAM, len(part))
    if not n:
        return 1.0
    wanted = _grams(part, n)
    return len(wanted & _grams(around, n)) / len(wanted)


def _hits(words: list[bytes], index: Index, threshold: float, cover: float) -> dict[int, tuple[float, float, float]]:
    """Verified items of a text: best retrieval score, question and answer cover."""
    places: dict[int, list[tuple[int, float]]] = defaultdict(list)
    for start, entry, score in search(words, index, threshold):
        places[int(index.item[entry])].append((start, score))
    out = {}
    for item, at in places.items():
        question, answer = index.texts[item]
        reach = len(question) + len(answer)
        for start, score in at:
            around = words[max(0, start - reach) : start + PASSAGE + reach]
            q, a = _cover(question, around), _cover(answer, around)
            if q >= cover and a >= cover and score > out.get(item, (0.0,))[0]:
                out[item] = (score, q, a)
    return out


def _items(items: DataFrame) -> DataFrame:
    """item_id and what an item says, with the ``key`` that items of the same words share."""
    named = {c.lower() for c in items.columns}
    pick = lambda c: (F.col(c) if c in named else F.lit(None)).cast("string")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), pick("text").alias("text"), pick("question").alias("q"), pick("answer").alias("a"))
    return rows.withColumn("key", F.md5(F.to_json(F.struct("text", "q", "a"))))


def _parts(text: str | None, q: str | None, a: str | None) -> tuple[list[bytes], list[bytes]]:
    return (item_words(q), item_words(a or "")) if q else question_and_answer(text or "")


def _stretches(words: list[bytes]) -> list[list[bytes]]:
    n = -(-len(words) // max(1, -(-len(words) // STRETCH)))
    return [words[k : k + n] for k in range(0, len(words), n or 1)]


def _average(distinct: DataFrame) -> float:
    """Words of a stretch on average over all items, so that a score does not depend on the items read with it."""

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            held = [sum(map(len, _parts(*r))) for r in zip(frame["text"], frame["q"], frame["a"])]
            yield pd.DataFrame({"words": [sum(held)], "entries": [sum(-(-n // STRETCH) for n in held)]})

    row = distinct.select("text", "q", "a").mapInPandas(sizes, "words long, entries long").agg(F.sum("words"), F.sum("entries")).first()
    return (row[0] or 0) / (row[1] or 1)


def _document_frequencies(source: DataFrame, vocabulary: list[bytes]) -> dict[bytes, float]:
    """BM25 idf of each word of ``vocabulary`` over all rows of ``source``."""
    sent = source.sparkSession.sparkContext.broadcast({w: k for k, w in enumerate(vocabulary)})

    def frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts, n = sent.value, np.zeros(len(sent.value) + 1, np.int64), 0
        for frame in frames:
            n += len(frame)
            for text in frame[TEXT]:
                counts[[known[w] for w in known.keys() & set(item_words(text))]] += 1
        counts[-1] = n
        held = np.flatnonzero(counts)
        yield pd.DataFrame({"term": held, "n": counts[held]})

    counted = source.select(TEXT).mapInPandas(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in counted.collect()}  # bounded by the words of the items read at once
    total = df.pop(len(vocabulary), 0)
    return {w: float(np.log(1 + (total - df.get(k, 0) + 0.5) / (df.get(k, 0) + 0.5))) for k, w in enumerate(vocabulary)}


def _searched(source: DataFrame, texts: dict[str, tuple[list[bytes], list[bytes]]], average: float, threshold: float, cover: float) -> DataFrame:
    """Hits of some items in all rows: (doc_id, row_key, key, score, question_cover, answer_cover)."""
    keys = sorted(texts)
    stretches = [_stretches(texts[k][0] + texts[k][1]) for k in keys]
    idf = _document_frequencies(source, sorted({w for parts in stretches for words in parts for w in words}))
    # all stretches of an item stand in one part, so that a row meets an item once
    parts, held = [[]], 0
    for k, own in enumerate(stretches):
        if held and held + len(own) > ENTRIES:
            parts.append([])
            held = 0
        parts[-1].append(k)
        held += len(own)
    found = None
    for part in parts:
        entries = [(k, words) for k in part for words in stretches[k]]
        built = build_index(entries, {k: texts[keys[k]] for k in part}, idf, average)
        index = source.sparkSession.sparkContext.broadcast((built, {k: keys[k] for k in part}))

        def searched(frames: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            at, names = index.value
            for frame in batches(frames, 1_000):
                out = []
                for doc, text, key in zip(frame[ID], frame[TEXT], frame["row_key"]):
                    for item, (score, q, a) in _hits(item_words(text), at, threshold, cover).items():
                        out.append((doc, key, names[item], score, q, a))
                got = pd.DataFrame(out, columns=["doc_id", "row_key", "key", "score", "question_cover", "answer_cover"])
                yield got.astype({"doc_id": "Int64"})

        hits = source.mapInPandas(searched, "doc_id long, row_key long, key string, score double, question_cover double, answer_cover double")
        found = hits if found is None else found.union(hits)
    return found


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, cover: float = COVER, most_items: int = 200_000) -> DataFrame:
    """(doc_id, row_key, item_id, score, question_cover, answer_cover) for each row of ``docs`` and test item it holds.

    ``items`` has item_id and text, or question and answer columns beside them. Items are cut into stretches of at most
    STRETCH words, the entries of a BM25 index whose idf is counted over all rows of ``docs``. Every passage of every text
    is a query; entries at or above the threshold are retrieved, and an item counts only when enough n-grams of its
    question and of its answer stand around that passage.

    Distinct items are read ``most_items`` at a time, each lot searched in passes of its own whose hits are written to the
    shared folder, so any number of items is searched with the same result. The index of a lot is broadcast in parts of
    about ENTRIES entries, so what a worker holds is bounded too. Null and empty texts hold nothing and items without
    words are left out. An item is its words, not its id: those of one id are all searched, and a hit comes with every
    id (null too) that has the item. ``row_key`` (xxhash64 of the text) tells apart rows of one id; repeated rows come
    back repeated.
    """
    asked = _items(items)
    distinct = asked.select("key", "text", "q", "a").dropDuplicates(["key"])
    source = id_and_text(docs).withColumn("row_key", F.xxhash64(TEXT))
    found = None
    average = _average(distinct)
    rows = distinct.toLocalIterator()
    while lot := list(islice(rows, most_items)):
        texts = {r["key"]: _parts(r["text"], r["q"], r["a"]) for r in lot}
        texts = {k: pair for k, pair in texts.items() if pair[0] or pair[1]}
        if texts:
            hits = temporary_table(_searched(source, texts, average, threshold, cover), "contaminated")
            found = hits if found is None else found.union(hits)
    columns = ["doc_id", "row_key", "item_id", "score", "question_cover", "answer_cover"]
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, row_key long, item_id long, score double, question_cover double, answer_cover double")
    return found.join(asked.select("item_id", "key").distinct(), "key").select(columns)
