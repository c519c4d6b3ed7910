"""Token counts of byte-level BPE by merging pairs with a heap over a linked list; no token ids are made."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame

from lakeops.llm.common import ID, TEXT, WordCache, batches, id_and_text, per_worker

#: How byte-level BPE vocabularies of this kind split text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 512
_LONG = 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes themselves, others from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return [hidden.get(b, chr(b)) for b in range(256)]


class PairMerger:
    """Merge ranks of a byte-level BPE file and the count of a text's tokens under them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout") or spec["normalizer"] is not None:
            raise ValueError(f"{path}: a plain byte-level BPE file is needed")
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ", 1)): k for k, m in enumerate(model["merges"])}
        self.letters = byte_letters()
        self.split = regex.compile(SPLIT)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.counts = WordCache(self.merged)

    def merged(self, word: str) -> int:
        """Symbols of a pre-token minus its merges, always merging the lowest-ranked adjacent pair, leftmost first."""
        letters, ranks = self.letters, self.ranks
        symbols = [letters[b] for b in word.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
        if not heap:
            return n
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            _, i, a, b = heappop(heap)
            if symbols[i] != a or (j := after[i]) >= n or symbols[j] != b:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = a + b, None
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((a + b, symbols[k]))) is not None:
                    heappush(heap, (r, i, a + b, symbols[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get((symbols[h], a + b))) is not None:
                heappush(heap, (r, h, symbols[h], a + b))
        return left

    def _plain(self, text: str) -> int:
        if len(text) > _LONG:  # no list of all pre-tokens
            counts = self.counts
            return sum(counts[m.group()] for m in self.split.finditer(text))
        return sum(map(self.counts.__getitem__, self.split.findall(text)))

    def count(self, text: str) -> int:
        """Tokens of a text; a special string inside it counts as its one token."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have no bytes and no tokens; repeated rows are counted each; null ids stay. A map over rows
    without a shuffle: each worker keeps the counts of pre-tokens it met lately, in bounded memory. ``path`` is a
    byte-level BPE file that every executor can read.
    """

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merger = per_worker(lambda: PairMerger(path), f"merger {path}")
        for frame in batches(frames, 2_000):
            n = [merger.count(t) for t in frame[TEXT]]
            yield pd.DataFrame(
                {
                    "doc_id": frame[ID].astype("Int64"),
                    "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in frame[TEXT]],
                    "n_tokens": n,
                    "over_limit": [k > limit for k in n],
                }
            )

    return id_and_text(docs).mapInPandas(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
