"""Alignment of two tokenizers' tokens by coalescing their byte intervals, and how often their ids meet in a corpus."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.automaton import MergeAutomaton
from lakeops.llm.common import CACHE, ID, TEXT, batches, id_and_text, per_worker, temporary_table
from lakeops.llm.pieces import SPACE

#: Tokens of a batch that are sorted together; a longer document is a batch of its own.
_TOGETHER = 1 << 18


def groups_of(starts_a, ends_a, starts_b, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each A interval and of each B interval.

    All intervals are sorted by start together; the running maximum of their ends tells where a start reaches
    what has been covered so far, and there a new group begins. The rows of each side are in ascending order.
    """
    n = len(starts_a)
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    side = np.repeat(np.array([0, 1], np.int8), [n, len(starts_b)])
    order = np.lexsort((side, starts))
    covered = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= covered[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[:n], group[n:]


def overlaps(starts_a, ends_a, starts_b, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all A and B intervals that share a byte; each side covers its bytes without gaps and in order."""
    first = np.searchsorted(ends_b, starts_a, "right")
    n = np.searchsorted(starts_b, ends_a, "left") - first
    i = np.repeat(np.arange(len(starts_a)), n)
    j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return i, j


class Aligner:
    """Tokens of a text under a byte-level BPE file (A) and a piece model (B), as ids, their bytes and lengths."""

    def __init__(self, path_a: str, path_b: str, cache_bytes: int = 3 * CACHE // 5):
        # a smaller cache than where the coder is alone: the worker holds the piece model and the links of a task too
        self.coder = MergeAutomaton(path_a, cache_bytes)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = self.coder.bytes, []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.pieces.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.size_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.size_b = np.array([len(b) for b in self.bytes_b], np.int64)
        #: Decimal ids, each with the separators , | ; behind it, filled up with zero bytes.
        largest = max(len(self.bytes_a), len(self.bytes_b))
        self.written = np.array([f"{i}{s}".encode() for i in range(largest) for s in ",|;"])

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space + text under A and of text under B; none where the bytes of either are not those of space + text."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not text:
            return none
        whole = " " + text
        raw = self.pieces.encode(text, num_threads=1)
        expected = whole.encode()
        if b"".join(map(self.bytes_b.__getitem__, raw)) != expected:
            return none
        # the labels of a path spell the text, so A has these bytes always
        a = np.frombuffer(self.coder.encode(whole, special=False), "<u4").astype(np.int64)
        return a, np.array(raw, np.int64)

    def align(self, texts: list[str]) -> pd.DataFrame:
        """Per text n_a, n_b, n_groups, group_ids (the groups as text), pairs_a and pairs_b (ids of all overlapping pairs) and together (whether a pair ends together)."""
        found = [self.tokens(t) for t in texts]
        n_a, n_b = (np.array([len(f[k]) for f in found], np.int64) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
        # texts lie one behind the other, so that one sort does for all
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        starts_a, starts_b = ends_a - self.size_a[ids_a], ends_b - self.size_b[ids_b]
        text_a, text_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        group_a, group_b = groups_of(starts_a, ends_a, starts_b, ends_b)
        i, j = overlaps(starts_a, ends_a, starts_b, ends_b)
        bounds = np.append(0, np.cumsum(np.bincount(text_a[i], minlength=len(texts))))
        last = np.append(group_a[1:] != group_a[:-1], True)[: len(ids_a)]
        n_groups = np.bincount(text_a[last], minlength=len(texts))
        pairs_a, pairs_b, together = ids_a[i], ids_b[j], ends_a[i] == ends_b[j]
        at = list(zip(bounds[:-1], bounds[1:]))
        return pd.DataFrame(
            {
                "n_a": n_a,
                "n_b": n_b,
                "n_groups": n_groups,
                "group_ids": self._written(ids_a, group_a, text_a, ids_b, group_b, text_b, len(texts)),
                "pairs_a": [pairs_a[x:y] for x, y in at],
                "pairs_b": [pairs_b[x:y] for x, y in at],
                "together": [together[x:y] for x, y in at],
            }
        )

    def _written(self, ids_a, group_a, text_a, ids_b, group_b, text_b, n: int) -> list[bytes]:
        """The groups of each text as a1,a2|b1;a3|b2,b3."""
        group, side = np.concatenate([group_a, group_b]), np.repeat(np.array([0, 1], np.int8), [len(ids_a), len(ids_b)])
        order = np.argsort(group * 2 + side, kind="stable")
        ids, group, side = np.concatenate([ids_a, ids_b])[order], group[order], side[order]
        text = np.concatenate([text_a, text_b])[order]
        ends = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[: len(ids)]
        letters = self.written[ids * 3 + np.where(ends, 1 + side, 0)]
        bounds = np.searchsorted(text, np.arange(n + 1))
        return [letters[x:y].tobytes().replace(b"\0", b"")[:-1] for x, y in zip(bounds[:-1], bounds[1:])]


def _aligner(path_a: str, path_b: str) -> Aligner:
    return per_worker(lambda: Aligner(path_a, path_b), f"aligner {path_a} {path_b}")


def _aligned(frames: Iterator[pd.DataFrame], aligner: Aligner) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """Ids and alignment of documents, in batches of about the same size whatever the length of their texts."""
    for frame in batches(frames, 500):
        sizes = frame[TEXT].str.len().to_numpy()
        run = np.cumsum(sizes) // _TOGETHER
        for at in np.unique(run):
            part = frame[run == at]
            yield part, aligner.align(part[TEXT].tolist())


def aligned_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, group_ids, and overlaps (array of a, b, together), all pairs of tokens that share a byte.

    Byte offsets are those of space + text. A text whose tokens' bytes are not these (normalised text, say), a null and an
    empty one have no tokens: zeros and empty values. Repeated rows are aligned each, null ids stay, other columns are left out.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, found in _aligned(frames, _aligner(path_a, path_b)):
            pairs = [[{"a": int(a), "b": int(b), "together": bool(t)} for a, b, t in zip(*row)] for row in zip(found["pairs_a"], found["pairs_b"], found["together"])]
            out = found[["n_a", "n_b", "n_groups"]].assign(group_ids=[g.decode() for g in found["group_ids"]], overlaps=pairs)
            out.insert(0, "doc_id", part[ID].astype("Int64").to_numpy())
            yield out

    schema = "doc_id long, n_a long, n_b long, n_groups long, group_ids string, overlaps array<struct<a:int,b:int,together:boolean>>"
    return id_and_text(docs).mapInPandas(rows, schema)


class _Counts:
    """How often each linked pair of ids occurs, and whether that is the most for its B id."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray, size_b: int):
        by = np.argsort(pairs)
        self.pairs, self.n, b = pairs[by], n[by], pairs[by] % size_b
        most = np.zeros(size_b, np.int64)
        np.maximum.at(most, b, self.n)
        self.best = self.n == most[b]


class _Tally:
    """Numbers and how often they came, as sorted arrays; new ones wait until there are enough to be worth a sort."""

    def __init__(self, together: int = 1_000_000):
        self.values, self.n, self.waiting, self.held, self.together = np.empty(0, np.int64), np.empty(0, np.int64), [], 0, together

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.held += len(values)
        if self.held > self.together:
            self.sum_up()

    def sum_up(self) -> None:
        values, n = np.unique(np.concatenate([np.empty(0, np.int64), *self.waiting]), return_counts=True)
        self.waiting, self.held = [], 0
        every, place = np.unique(np.concatenate([self.values, values]), return_inverse=True)
        self.values, self.n = every, np.bincount(place, np.concatenate([self.n, n]), len(every)).astype(np.int64)


_LINKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pair long, n long"


def linked_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per row of ``docs``, with its links as 64-bit numbers in bytes, and rows (pair, n) of how often each link came in a task.

    The link of a and b has the number a * (size of B) + b. Two tokens that end together are each other's suffix, so for a vocabulary with tokens of L bytes in all
    there are at most L such pairs for each spelling of the other: what a task counts is bound by the vocabularies, not by its documents.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, tally = _aligner(path_a, path_b), _Tally()
        size_b = len(aligner.bytes_b)
        for part, found in _aligned(frames, aligner):
            links = [a[t] * size_b + b[t] for a, b, t in zip(found["pairs_a"], found["pairs_b"], found["together"])]
            tally.add(np.concatenate(links))
            digests = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(found["group_ids"], found["n_a"])]
            out = found[["n_a", "n_b", "n_groups"]].assign(n_links=[len(x) for x in links], groups_sha256=digests, links=[x.tobytes() for x in links])
            out.insert(0, "doc_id", part[ID].astype("Int64").to_numpy())
            none = pd.array([None] * len(out), "Int64")
            yield out.assign(pair=none, n=none)
        tally.sum_up()
        none = pd.array([None] * len(tally.n), "Int64")
        same = {c: none for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        yield pd.DataFrame({**same, "groups_sha256": None, "links": None, "pair": tally.values, "n": tally.n})

    return id_and_text(docs).mapInPandas(rows, _LINKED)


def link_counts(linked: DataFrame) -> DataFrame:
    """(pair, n): how many links of the corpus hold an id of A and one of B."""
    return linked.where("n is not null").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment_digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of tokens that end together, its count the number of links of the corpus with the same two ids.
    ``n_best`` counts the links whose count is the highest of their B id (ties included), ``count_sum`` adds up the counts. Texts without
    tokens (see ``aligned_groups``) have zeros and an empty digest; repeated rows count each.

    The texts are encoded once; their links lie in a table in the shared folder. The counts of all pairs are sent to every task: see
    ``linked_tokens`` for their bound, half a million rows for vocabularies of 50,000 and 32,000.
    """
    spark = docs.sparkSession
    linked = temporary_table(linked_tokens(docs, path_a, path_b), "alignment")
    table = link_counts(linked).toPandas()
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = spark.sparkContext.broadcast(_Counts(table["pair"].to_numpy(np.int64), table["n"].to_numpy(np.int64), size_b))

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        per_worker(list, "no model")  # the models of the stage before are not needed any more
        known = counts.value
        for frame in frames:
            best, total = [], []
            for row in frame["links"]:
                at = np.searchsorted(known.pairs, np.frombuffer(row, np.int64))
                best.append(int(known.best[at].sum()))
                total.append(int(known.n[at].sum()))
            yield frame.drop(columns="links").assign(doc_id=frame[ID].astype("Int64"), n_best=best, count_sum=total)

    columns = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return linked.where("n is null").drop("pair", "n").mapInPandas(scored, columns)
