"""Byte-pair encoding by a deterministic automaton over tokens, compiled from the merges, and decoding by its arc labels."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from lakeops.llm.common import CACHE, ID, TEXT, WordCache, batches, id_and_text, per_worker
from lakeops.llm.token_counts import SPLIT, byte_letters

_LONG = 1 << 20
#: Entries of the transition table that a worker keeps at a time.
MOVES = 1 << 20


class _Moves(dict):
    """The transition table: whether the arc t leaves the state of u, under the key u << 24 | t. Emptied when it has MOVES entries."""

    def __init__(self, leaves):
        super().__init__()
        self.leaves = leaves

    def __missing__(self, key: int) -> bool:
        if len(self) >= MOVES:
            self.clear()
        found = self[key] = self.leaves(key >> 24, key & 0xFFFFFF)
        return found


class MergeAutomaton:
    """The automaton whose paths are exactly the token rows that merging makes.

    It starts as one state with an arc back to itself for every byte. The merges are put in one after the other, by
    rank. The gadget of a merge of u and v does three things:

    * the state that u leads to is copied without its arc v, and the arcs u are led to the copy: v no longer follows u;
    * wherever an arc u starts, an arc uv starts now (for u = v: where u is still left, as the leftmost pair is merged);
    * the arc uv leads to where v led after u before.

    Written out, the copies would have a row of all labels each. They are kept as what differs: a state is named by
    the label that leads to it, ``gone[u]`` has the arcs taken out of its own copies with the rank that took them, and
    all else is that of the state it was copied from, which is the state of v as it stood when uv was made. So
    an arc t leaves the state of u unless some merge took it out of one of the states u was copied from, for t or for a label that
    t was built on, while one was still a copy of the other. ``ends`` and ``starts`` list these ancestors with the rank up to which they count.

    ``moves`` is the transition table over (state, arc), filled from those rows as arcs are first looked up. Every prefix of a word
    has exactly one path. Encoding walks from boundary to boundary, longest label first, along arcs that the table allows.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        splitter = spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        if not plain or spec["normalizer"] is not None or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError(f"{path}: a plain byte-level BPE file is needed")
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        spelled = lambda token: bytes(byte_of[c] for c in token).decode("latin-1")  # noqa: E731  one character per byte
        vocab = model["vocab"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
        never = len(merges)

        missing = [c for c in letters if c not in vocab]
        if missing:
            raise ValueError(f"{path}: no token for some bytes")
        size = max(vocab.values()) + 1
        self.gone: list[dict[int, int]] = [{} for _ in range(size)]
        self.ends: list[tuple] = [((t, never),) for t in range(size)]
        self.starts: list[tuple] = [((t, never),) for t in range(size)]
        self.label = [""] * size
        for c in letters:
            self.label[vocab[c]] = spelled(c)
        made = set(vocab[c] for c in letters)
        for rank, (left, right) in enumerate(merges):
            u, v, uv = vocab[left], vocab[right], vocab[left + right]
            if uv in made:
                raise ValueError(f"{path}: two merges make the token {uv}")
            if u not in made or v not in made or not self.leaves(u, v):
                continue  # no path has u before v, so nothing is ever merged
            made.add(uv)
            self.label[uv] = spelled(left + right)
            self.ends[uv] = ((uv, never), *((t, min(until, rank)) for t, until in self.ends[v]))
            until_start = rank + 1 if u == v else rank
            self.starts[uv] = ((uv, never), *((t, min(until, until_start)) for t, until in self.starts[u]))
            self.gone[u][v] = rank

        self.moves = _Moves(self.leaves)
        #: Every beginning of a label, with the labels that it begins with, longest first.
        self.arcs_of: dict[str, tuple[int, ...]] = {}
        spelling = {self.label[t]: t for t in made}
        for word in spelling:
            arcs: tuple[int, ...] = ()
            for k in range(1, len(word) + 1):
                arcs = self.arcs_of.get(word[:k]) or self.arcs_of.setdefault(word[:k], (spelling[word[:k]], *arcs) if word[:k] in spelling else arcs)
        self.size = [len(s) for s in self.label]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [s.encode("latin-1") for s in self.label]
        for content, i in self.special.items():
            self.bytes.extend([b""] * (i + 1 - len(self.bytes)))
            self.bytes[i] = content.encode()
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.split = regex.compile(SPLIT)
        self.words = WordCache(self._word, cache_bytes)

    def leaves(self, u: int, t: int) -> bool:
        """Whether the arc t leaves the state that u leads to."""
        gone, starts = self.gone, self.starts[t]
        for state, before in self.ends[u]:
            taken = gone[state]
            if taken:
                for label, until in starts:
                    rank = taken.get(label)
                    if rank is not None and rank < until and rank < before:
                        return False
        return True

    def path(self, letters: str) -> list[int]:
        """Labels of the one path that spells a word, given with one character per byte.

        Any allowed walk to a boundary is the path of that prefix, so a boundary from which the word cannot be finished
        is left behind for good, and each boundary is walked from once.
        """
        arcs_of, moves, size, n = self.arcs_of.get, self.moves, self.size, len(letters)
        found = arcs_of(letters)
        if found and size[found[0]] == n:
            return [found[0]]
        out, walked, closed = [], [], set()
        i, row = 0, -1
        while i < n:
            k = i + 3
            found = arcs_of(letters[i:k])
            if found is None:
                found = arcs_of(letters[i : i + 2]) or arcs_of(letters[i])
            else:
                while k < n:
                    k += 1
                    more = arcs_of(letters[i:k])
                    if more is None:
                        break
                    found = more
            arcs = iter(found)
            while True:
                for t in arcs:
                    if (row < 0 or moves[row | t]) and (not closed or i + size[t] not in closed):
                        break
                else:
                    closed.add(i)
                    arcs = walked.pop()
                    i -= size[out.pop()]
                    row = out[-1] << 24 if out else -1
                    continue
                break
            walked.append(arcs)
            out.append(t)
            i += size[t]
            row = t << 24
        return out

    def _word(self, word: str) -> bytes:
        return np.array(self.path(word.encode("utf-8", "surrogatepass").decode("latin-1")), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        words = self.words
        if len(text) > _LONG:  # no list of all pre-tokens
            return b"".join(words[m.group()] for m in self.split.finditer(text))
        return b"".join(map(words.__getitem__, self.split.findall(text)))

    def encode(self, text: str, special: bool = True) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; with ``special`` a special string in it is its one token."""
        if not special or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut.split(text)
        return b"".join(np.array([self.special[p]], "<u4").tobytes() if k % 2 else self._plain(p) for k, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """The labels of the path in order, as text; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def automaton(path: str) -> MergeAutomaton:
    """The compiled automaton of a file, one per Python worker."""
    return per_worker(lambda: MergeAutomaton(path), f"automaton {path}")


def encode_bpe(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array<long>), as the tokenizers library encodes the text without added special tokens.

    Null and empty texts have no ids; repeated rows are encoded each; null ids stay; other columns are left out. ``path``
    is a byte-level BPE file that every executor can read. A map over rows without a shuffle; a worker holds the automaton, a bounded
    cache of words and one batch of documents.
    """

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = automaton(path)
        for frame in batches(frames, 500):
            ids = [np.frombuffer(coder.encode(t), "<u4").astype(np.int64) for t in frame[TEXT]]
            yield pd.DataFrame({"doc_id": frame[ID].astype("Int64"), "ids": ids})

    return id_and_text(docs).mapInPandas(encoded, "doc_id long, ids array<long>")


def decode_bpe(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), special tokens included; null ids of a row give an empty text."""

    def decoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = automaton(path)
        for frame in frames:
            texts = [coder.decode(np.asarray(i, "<u4").tobytes()) if i is not None else "" for i in frame["ids"]]
            yield pd.DataFrame({"doc_id": frame[ID].astype("Int64"), "text": texts})

    return encoded.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<long>) ids").mapInPandas(decoded, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit), decoded_sha256 (of the decoded text in UTF-8).

    Encodes and decodes in one pass, with the rules of ``encode_bpe``; null and empty texts have the digests of nothing.
    """

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = automaton(path)
        for frame in batches(frames, 2_000):
            n, ids_digest, text_digest = [], [], []
            for text in frame[TEXT]:
                ids = coder.encode(text)
                n.append(len(ids) // 4)
                ids_digest.append(hashlib.sha256(ids).hexdigest())
                text_digest.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pd.DataFrame({"doc_id": frame[ID].astype("Int64"), "n_tokens": n, "ids_sha256": ids_digest, "decoded_sha256": text_digest})

    return id_and_text(docs).mapInPandas(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
