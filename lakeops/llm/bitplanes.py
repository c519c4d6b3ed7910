"""Token ids written in doc_id order as compressed bit planes, and read back.

A shard is one run of ids: documents in ascending doc_id, each closed by an end id. It is a set of rows in one Parquet
file, in two kinds, ``chunk`` and ``document``.

* Chunk rows hold the ids. A chunk has a fixed number of them (the last of a shard may have fewer). Its ids, as
  little-endian unsigned integers of 2 or 4 bytes, are transposed: plane j holds bit j of every id, eight ids to a byte (or byte j of every id, one id
  to a byte), and each plane is compressed with zstandard by itself. ``planes`` is their concatenation and ``ends`` the chunk's index: where
  each plane ends in it.
* Document rows are the index of documents: ``at`` is the place of a document's first id in its shard, ``n`` its ids with
  the end id, ``chunk`` the chunk that holds its last one.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.common import CACHE, ID, TEXT, WordCache, batches, id_and_text, per_worker
from lakeops.llm.token_counts import byte_letters

CHUNK, END_ID, LEVEL = 65_536, 2, 3
_ROWS = "shard int, kind string, chunk long, doc_id long, at long, n long, width int, bits boolean, ends array<int>, planes binary"


def to_planes(ids: np.ndarray, bits: bool, level: int = LEVEL) -> tuple[list[int], bytes]:
    """Ends and concatenation of the compressed planes of an array of unsigned integers."""
    raw = np.ascontiguousarray(ids).view(np.uint8).reshape(len(ids), ids.itemsize)
    planes = np.ascontiguousarray(raw.T)
    if bits:
        planes = [np.packbits(column & np.uint8(1 << bit)) for column in planes for bit in range(8)]
    squeeze = zstandard.ZstdCompressor(level=level)
    parts = [squeeze.compress(p.tobytes()) for p in planes]
    return np.cumsum([len(p) for p in parts]).tolist(), b"".join(parts)


def from_planes(ends, planes: bytes, n: int, width: int, bits: bool) -> np.ndarray:
    """The ids of a chunk as unsigned 32-bit integers."""
    expand = zstandard.ZstdDecompressor()
    parts = [expand.decompress(planes[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    if len(parts) != width * (8 if bits else 1):
        raise ValueError(f"{len(parts)} planes of ids of {width} bytes")
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(parts):
        values = np.frombuffer(plane, np.uint8)
        if bits:
            values = np.unpackbits(values, count=n)
        ids |= values.astype(np.uint32) << np.uint32(k if bits else 8 * k)
    return ids


#: Text of ASCII and Latin-1 letters, digits, ASCII signs, spaces and line ends: its composed and lower-case forms are plain, so is where the query's tokenizer cuts it.
_PLAIN = re.compile(r"[ \n\x21-\x7eÀ-ÖØ-öø-ÿ]*")
#: How the tokenizer cuts such a text in lower case. Letters come first; its rule tries endings behind an apostrophe first, where no letter stands.
_CUT = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \na-zß-öø-ÿ0-9]+")


class WordEncoder:
    """Ids of texts by the tokenizers library, word by word.

    Only for tokenizers that throw white space away before merging and never look across it, as the one of the query
    does: then the ids of a text are those of its words one after the other, and a word met before need not be
    encoded again. Words in the middle of ordinary text are cut at spaces and line ends only. Where the tokenizer's own
    rule for lower case and cutting is the known one, plain texts and words are cut by it here, and the tokenizer's model gets the parts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        probe = "Ab c's, d1\n e"
        if self._ids(probe) != sum(map(self._ids, probe.split()), []):
            raise ValueError(f"{path}: ids of this tokenizer depend on white space")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.model, self.letters = self.tokenizer.model, {b: c for b, c in enumerate(byte_letters())}
        self.cuts = self._cuts_plain_words(spec)
        self.words = WordCache(self._word, CACHE // 4)
        self.parts = WordCache(self._part, CACHE)

    @staticmethod
    def _cuts_plain_words(spec: dict) -> bool:
        """Whether the file's normalizer and splitter do to plain words what _CUT does in lower case."""
        steps = [step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])]
        splitters = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        first = splitters[0] if splitters else {}
        pattern = first.get("pattern", {}).get("Regex") if first.get("type") == "Split" else None
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            and first.get("invert") is True
            and [step.get("type") for step in splitters[1:]] == ["ByteLevel"]
            and splitters[1].get("use_regex") is False
            and splitters[1].get("add_prefix_space") is False
            and spec["post_processor"] is None
            and all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
        )

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids that the file's model gives to a part, whose bytes stand as letters."""
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return self._packed([token.id for token in self.model.tokenize(letters)])

    def _plain(self, text: str) -> bytes | None:
        if not self.cuts or not _PLAIN.fullmatch(text) or self.special.search(text):
            return None
        return b"".join(map(self.parts.__getitem__, _CUT.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        found = self._plain(word)
        return self._packed(self._ids(word)) if found is None else found

    def encode(self, text: str) -> bytes:
        found = self._plain(text)
        if found is not None:
            return found
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, chunk: int = CHUNK, bits: bool = True, shards: int | None = None) -> None:
    """Encode every text of ``docs`` and write its ids to ``path`` in the format above, in ascending doc_id.

    Null texts are empty and have the end id only; null ids come first; rows of one id are ordered by a hash of their
    text, and all are written. Texts are dealt into ranges of doc_id (of any spacing) before they are encoded, so shard
    k holds lower ids than shard k + 1; a task holds one chunk and one document at a time. A task that runs again makes the same shard.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.monotonically_increasing_id()  # spreads and orders repeated rows
    rows = id_and_text(docs).withColumn("h", F.xxhash64(TEXT)).withColumn("tie", tie)
    rows = rows.repartitionByRange(shards, ID, "h", "tie").sortWithinPartitions(ID, "h", "tie").select(ID, TEXT)

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = per_worker(lambda: WordEncoder(tokenizer), f"words {tokenizer}")
        width, shard = coder.dtype.itemsize, TaskContext.get().partitionId()
        end, limit = np.array([end_id], coder.dtype).tobytes(), chunk * width
        waiting, written, at = bytearray(), 0, 0

        def flushed(size: int) -> tuple:
            ids = np.frombuffer(bytes(waiting[:size]), coder.dtype)
            del waiting[:size]
            return (shard, "chunk", written, None, written * chunk, len(ids), width, bits, *to_planes(ids, bits))

        columns = [c.split()[0] for c in _ROWS.split(", ")]
        frame_of = lambda out: pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64", "width": "Int32", "bits": "boolean"})
        for frame in batches(frames, 500):
            out = []
            for doc, text in zip(frame[ID], frame[TEXT]):
                ids = coder.encode(text) + end
                n = len(ids) // width
                waiting += ids
                out.append((shard, "document", (at + n - 1) // chunk, doc, at, n, None, None, None, None))
                at += n
                while len(waiting) >= limit:
                    out.append(flushed(limit))
                    written += 1
            yield frame_of(out)
        if waiting:
            yield frame_of([flushed(len(waiting))])

    # planes are compressed already
    rows.mapInPandas(encoded, _ROWS).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a written folder: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    return _documents(spark, path, lambda ids: ids.astype("<u4").tobytes(), "ids binary")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_ids``, with ids_crc32, the unsigned crc32 of those bytes, instead of the ids."""
    return _documents(spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "ids_crc32 long")


def _documents(spark: SparkSession, path: str, value, field: str) -> DataFrame:
    rows = spark.read.schema(_ROWS).parquet(path)
    # one row per shard
    sizes = rows.where("kind = 'document'").groupBy("shard").agg(F.sum("n").alias("ids"))
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select(F.col("shard").alias("of"), before.alias("base"))

    def joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, first, held = None, 0, np.empty(0, np.uint32)  # ids of the open chunks, from place ``first`` of the shard on
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if r.shard != shard:
                    shard, first, held = r.shard, 0, np.empty(0, np.uint32)
                if r.kind == "chunk":
                    ids = from_planes(r.ends, r.planes, int(r.n), int(r.width), bool(r.bits))
                    held = np.concatenate([held, ids])
                else:
                    at = int(r.at) - first
                    held, first = held[at:], int(r.at)
                    out.append((r.shard, r.doc_id, int(r.at), int(r.n), value(held[: int(r.n)])))
            yield pd.DataFrame(out, columns=["shard", "doc_id", "at", "n_tokens", "value"]).astype({"doc_id": "Int64"})

    # a chunk, then the documents that end in it
    dealt = rows.repartition("shard").sortWithinPartitions("shard", "chunk", "kind", "at")
    found = dealt.mapInPandas(joined, f"shard int, doc_id long, at long, n_tokens long, value {field.split()[1]}")
    found = found.join(F.broadcast(bases), found["shard"] == bases["of"])  # a row per shard
    return found.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", F.col("value").alias(field.split()[0]))
