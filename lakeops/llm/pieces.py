"""SentencePiece encoding by a streaming Viterbi search, and decoding."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import CACHE, ID, TEXT, WordCache, batches, id_and_text, per_worker

SPACE = "▁"
#: Pairs of pieces that a worker remembers at a time.
PAIRS = 1 << 20
#: Fixed value: the number of a BPE model's type.
BPE = 2


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message: integers, or the bytes of all others."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (message[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if message[at - 1] < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else (8 if tag & 7 == 1 else 4, at)
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


def model_type(proto: bytes) -> int:
    """Type of a piece model. The trainer's settings are field 2, the type is field 3 in it, 1 (unigram) by default and 2 for BPE."""
    return next((kind for number, settings in _fields(proto) if number == 2 for field, kind in _fields(settings) if field == 3), 1)


class _Fits(dict):
    """Whether two pieces may follow each other, under the key before << 24 | piece. Emptied when it has PAIRS entries."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key: int) -> bool:
        if len(self) >= PAIRS:
            self.clear()
        found = self[key] = self.compute(key >> 24, key & 0xFFFFFF)
        return found


class PieceCoder:
    """Ids of a BPE piece model and texts of ids. Models of another type are refused.

    The search goes over the normalized text once. A state is a boundary; a step is a piece that ends there. Pieces x
    and y may follow each other when merging the characters of x + y, best piece first and leftmost first, gives just
    x and y; a row of pieces is what the model gives to a text when all its neighbours may follow each other, so every
    boundary has one valid step back (any other has weight minus infinity) and the last boundary's path is the encoding. Only
    boundaries within the longest piece of the current place can still be stepped from. Whenever their paths back meet
    in one boundary, the ids up to it are final and are committed, and the window is cut off there.
    """

    def __init__(self, path: str, cache_bytes: int = 3 * CACHE // 2):
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        if (kind := model_type(model.serialized_model_proto())) != BPE:
            raise ValueError(f"{path}: a BPE model is needed; the steps of a model of type {kind} are weighed otherwise")
        size = model.get_piece_size()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError(f"{path}: a model with byte fallback is needed")
        self.longest = max(map(len, self.ids))
        #: Every beginning of a piece, with the pieces that it begins with, longest first.
        self.arcs: dict[str, tuple[int, ...]] = {}
        for p in self.ids:
            arcs: tuple[int, ...] = ()
            for k in range(1, len(p) + 1):
                if p[:k] not in self.arcs:
                    self.arcs[p[:k]] = (self.ids[p[:k]], *arcs) if p[:k] in self.ids else arcs
                arcs = self.arcs[p[:k]]
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.width = [len(p) for p in self.text]
        #: Two characters that no piece holds side by side are never merged over: a new search starts between them.
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        #: A piece never holds a space after another character, so a word starts a new search.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.bytes = [b""] * size
        for p, i in self.ids.items():
            self.bytes[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte_ids.items():
            self.bytes[i] = bytes([b])
        self.fits = _Fits(self._fits)
        self.parts = WordCache(self._part, cache_bytes)

    def _fits(self, before: int, piece: int) -> bool:
        """Whether merging the characters of both, best-scored piece first and leftmost first, stops at these two."""
        if before >= len(self.text) or piece >= len(self.text):
            return True  # a character that is in no piece is merged with nothing
        pair = self.text[before], self.text[piece]
        symbols, score = list(pair[0] + pair[1]), self.score
        while len(symbols) > 2:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return False
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols == list(pair) and symbols[0] + symbols[1] not in score

    def stream(self, text: str) -> Iterator[list[str]]:
        """Pieces of a normalized text, in committed runs; a character in no piece stands for itself."""
        size = len(self.text)
        for run in self._search(text):
            yield [self.text[p] if p < size else chr(p - size) for p in run]

    def _search(self, text: str) -> Iterator[list[int]]:
        """The runs of ``stream`` as ids; a character in no piece has an id beyond all others', its code point added to their number."""
        arcs_of, fits, size, longest, n = self.arcs.get, self.fits, len(self.text), self.longest, len(text)
        back: dict[int, int] = {}  # boundary -> boundary before it
        last: dict[int, int] = {0: -1}  # boundary -> piece that ends there
        done = 0
        for j in range(n):
            before = last.get(j)
            if before is None:
                continue
            k = j + 3
            arcs = arcs_of(text[j:k])
            if arcs is None:
                arcs = arcs_of(text[j : j + 2]) or arcs_of(text[j]) or ()
            else:
                while k < n:
                    k += 1
                    more = arcs_of(text[j:k])
                    if more is None:
                        break
                    arcs = more
            row = before << 24
            for piece in arcs:
                i = j + self.width[piece]
                if i not in last and (not j or fits[row | piece]):
                    back[i], last[i] = j, piece
            if j + 1 not in last and text[j] not in self.ids:
                # bytes stand for it
                back[j + 1], last[j + 1] = j, size + ord(text[j])
            at = j + 1
            if at == n or at % longest == 0:
                alive = {n} if at == n else {b for b in range(at, min(n, j + longest) + 1) if b in last}
                while len(alive) > 1:
                    top = max(alive)
                    alive.discard(top)
                    alive.add(back.get(top, done))
                meet = alive.pop()
                if meet > done:
                    path, b = [], meet
                    while b > done:
                        path.append(last[b])
                        b = back[b]
                    yield path[::-1]
                    done = meet
                    if at < n:
                        back = {b: j for b, j in back.items() if b > done}
                        last = {b: p for b, p in last.items() if b >= done}

    def _window(self, text: str) -> list[int]:
        """What ``_search`` gives for a text no longer than the window, in which nothing is committed before the end."""
        arcs_of, moves, width, n = self.arcs.get, self.fits, self.width, len(text)
        last, back = [0] * (n + 1), [-1] * (n + 1)
        back[0] = 0
        for j in range(n):
            if back[j] < 0:
                continue
            k = j + 3
            arcs = arcs_of(text[j:k]) if k <= n else None
            if arcs is None:
                arcs = arcs_of(text[j : j + 2]) or arcs_of(text[j]) or ()
            else:
                while k < n:
                    k += 1
                    more = arcs_of(text[j:k])
                    if more is None:
                        break
                    arcs = more
            row = last[j] << 24
            for piece in arcs:
                i = j + width[piece]
                if back[i] < 0 and (not j or moves[row | piece]):
                    back[i], last[i] = j, piece
            if back[j + 1] < 0 and text[j] not in self.ids:
                back[j + 1], last[j + 1] = j, len(self.text) + ord(text[j])
        path, b = [], n
        while b:
            path.append(last[b])
            b = back[b]
        return path[::-1]

    def _part(self, text: str) -> bytes:
        """Ids of a text that is searched as a whole, as unsigned 32-bit integers."""
        out, size = array("I"), len(self.text)
        for run in [self._window(text)] if len(text) <= self.longest else self._search(text):
            if max(run) < size:
                out.extend(run)
                continue
            for piece in run:
                out.extend([piece] if piece < size else [self.byte_ids[b] for b in chr(piece - size).encode("utf-8", "surrogatepass")])
        return out.tobytes()

    def _word(self, text: str) -> bytes:
        """Ids of a word, which is one part or several."""
        known = self.parts.get(text)
        if known is not None:
            return known
        joined, start, out = self.joined, 0, []
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in joined:
                out.append(self.parts[text[start:k]])
                start = k
        out.append(self.parts[text[start:]] if text else b"")
        return b"".join(out)

    def encode(self, text: str) -> array:
        text = self.model.normalize(text)
        out = array("I")
        if not text:
            return out
        if not self.by_word:
            out.frombytes(self._word(text))
            return out
        parts = text.split(SPACE)
        if "" in parts[1:] or parts[0]:  # runs of spaces belong to one word
            words = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)
        else:
            words = [SPACE + part for part in parts[1:]]
        known, word = self.parts.get, self._word
        out.frombytes(b"".join([known(w) or word(w) for w in words]))
        return out

    def decode(self, ids) -> str:
        """The text of ids; the space that the model puts before every text is taken off again."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (array<int>), n_pieces, ids_crc32, n_decoded, round_trip.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers, ``n_decoded`` the length of the decoded
    text, ``round_trip`` whether it equals the text. Null and empty texts have no ids and come back as empty texts;
    repeated rows are encoded each; null ids stay. No shuffle; a worker holds the model, one document and bounded caches.
    """

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = per_worker(lambda: PieceCoder(path), f"pieces {path}")
        for frame in batches(frames, 1_000):
            ids, crc, n, same = [], [], [], []
            for text in frame[TEXT]:
                found = coder.encode(text)
                decoded = coder.decode(found)
                ids.append(found)
                crc.append(zlib.crc32(found.tobytes()))
                n.append(len(decoded))
                same.append(decoded == text)
            yield pd.DataFrame(
                {
                    "doc_id": frame[ID].astype("Int64"),
                    "ids": [np.frombuffer(i, np.int32) for i in ids],
                    "n_pieces": [len(i) for i in ids],
                    "ids_crc32": crc,
                    "n_decoded": n,
                    "round_trip": same,
                }
            )

    schema = "doc_id long, ids array<int>, n_pieces long, ids_crc32 long, n_decoded long, round_trip boolean"
    return id_and_text(docs).mapInPandas(encoded, schema)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids of a row give an empty text."""

    def decoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = per_worker(lambda: PieceCoder(path), f"pieces {path}")
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame[ID].astype("Int64"), "text": [coder.decode(i) if i is not None else "" for i in frame["ids"]]})

    return encoded.select(F.col(ID).cast("long").alias(ID), F.col("ids").cast("array<int>").alias("ids")).mapInPandas(decoded, "doc_id long, text string")
