"""Token ids as length-delimited binary records with masked checksums, and an offset index.

A shard file is a sequence of frames, in ascending doc_id order over the shards by number:

    u64 length | u32 masked CRC-32 of those 8 bytes | payload | u32 masked CRC-32 of the payload | 0x0A

A payload is ``i64 doc_id | u8 flags | ids``; flag bit 0: the ids take 4 bytes each, else 2; bit 1: doc_id is null. All
numbers are little-endian. The mask turns a checksum right by 15 bits and adds 0xA282EAD8, so that a checksum stored in
checksummed data can't cancel itself. Spark's text writer puts the frames out as they are, 0x0A being its line end, so
shards are committed by Spark's protocol to whatever file system the path names, and survive lost tasks.

The index has a row per record: shard, seq, offset, length, doc_id, n_tokens, ids_crc32 and the tokens before it in its
shard. read_shuffled() visits the records in a seeded random order through it.

Defined results: null and empty texts have the end id only; a null doc_id comes first and is kept as null; repeated
rows are separate records; equal doc_ids are ordered by text; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

MASK_DELTA = 0xA282EAD8
SHARD_BYTES, MOST_BYTES, SHARDS = 12 << 20, 128 << 20, 10_000  # a shard's text: the least, the most, and how many shards the least is kept for
MEMO, LONGEST = 250_000, 64  # words remembered by a worker; longer words are encoded each time
HEAD, ID = struct.Struct("<QI"), struct.Struct("<qB")
AROUND = HEAD.size + 5  # bytes of a frame beside its payload
INDEX = "shard int, seq int, offset long, length long, doc_id long, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    n = struct.pack("<Q", len(payload))
    return n + struct.pack("<I", masked(n)) + payload + struct.pack("<I", masked(payload)) + b"\n"


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and payload of each record; ValueError where a checksum or a length is wrong."""
    at = 0
    while at < len(data):
        if at + HEAD.size > len(data):
            raise ValueError(f"cut off in a header at {at}")
        n, crc = HEAD.unpack_from(data, at)
        start = at + HEAD.size
        if masked(data[at : at + 8]) != crc:
            raise ValueError(f"wrong length checksum at {at}")
        payload, tail = data[start : start + n], data[start + n : start + n + 5]
        if len(tail) != 5 or masked(payload) != struct.unpack("<I", tail[:4])[0] or tail[4:] != b"\n":
            raise ValueError(f"wrong record at {at}")
        yield at, payload
        at = start + n + 5


def pack(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    return ID.pack(doc_id or 0, wide | (doc_id is None) << 1) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = ID.unpack_from(payload)
    return None if flags & 2 else doc_id, np.frombuffer(payload, "<u4" if flags & 1 else "<u2", offset=ID.size).astype("<u4")


class _Memo(dict):
    """Encodes what it doesn't hold. When full, its entries become the older generation, from which those still in use return."""

    def __init__(self, encode, most: int):
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Whole-text encoding by the library, with a memo of words.

    A tokenizer that normalises to lower-case NFC, splits by the pattern below and drops white space treats each match by
    itself, so in a text of ASCII and Latin-1 letters (which NFC and lower-casing leave alone, one by one) matches can be
    looked up or go to its model directly. Other texts, those with special tokens, and all texts of other tokenizers are
    encoded as a whole. test_op09 holds both ways against each other.
    """

    #: The tokenizer file's split pattern, and the same over the letters and digits of such texts.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    MATCHES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+").findall
    OTHER = re.compile("[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<\\|").search

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = "<u4" if self.wide else "<u2"
        self.pack = "<%dI" if self.wide else "<%dH"
        made = json.loads(self.tokenizer.to_str())
        normal, split = json.dumps(made["normalizer"]), json.dumps(made["pre_tokenizer"])
        special = all(t["content"].startswith("<|") for t in made["added_tokens"])
        self.by_word = special and made["model"]["type"] == "BPE" and all(x in normal for x in ('"NFC"', '"Lowercase"')) and all(x in split for x in ('"Removed"', '"ByteLevel"', json.dumps(self.PATTERN)))
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.words = _Memo(self._word, MEMO)

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(word if word.isascii() and word.isalpha() else self.byte_level(word)[0][0])]
        return struct.pack(self.pack % len(ids), *ids)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        of, plain = self.words.__getitem__, self.by_word
        return [b"".join(map(of, self.MATCHES(t.lower()))) if plain and not self.OTHER(t) else self._whole(t) for t in (t or "" for t in texts)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind).tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process, kept between tasks."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def shard_count(size: int, shard_bytes: int | None = None) -> int:
    """Shards grow from 12 to 128 MB of stored text as the table does; then their number grows. A reader holds one at a time."""
    return max(2, math.ceil(size / (shard_bytes or min(MOST_BYTES, max(SHARD_BYTES, size // SHARDS)))))


def write(spark: SparkSession, docs: DataFrame, out: str, *, tokenizer: str, end_id: int = 1, shard_bytes: int | None = None) -> None:
    """Encode docs(doc_id, text) and write shards in doc_id order to ``out``.

    The shards are ranges of doc_id: one shuffle of the texts, none of the ids.
    """
    shards = shard_count(int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())), shard_bytes)
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:  # without the 0x0A, which the writer puts
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.kind).tobytes()
        for b in batches:
            ids, texts = [i if k else None for i, k in zip(b.doc_id.tolist(), b.known.tolist(), strict=True)], b.text.tolist()
            for k in range(0, len(ids), 256):
                part = slice(k, k + 256)
                yield pd.DataFrame({"record": [frame(pack(i, t + end, enc.wide))[:-1] for i, t in zip(ids[part], enc(texts[part]), strict=True)]})

    ordered.mapInPandas(encode, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(out)



def shard_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")


def index(spark: SparkSession, path: str) -> DataFrame:
    """Read the shards back, check every frame, and list the records."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for shard, content in zip(b.shard, b.content, strict=True):
                rows, start, data = [], 0, bytes(content)
                for seq, (at, payload) in enumerate(frames(data)):
                    doc_id, ids = unpack(payload)
                    rows.append((shard, seq, at, len(payload) + AROUND, doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                out = pd.DataFrame(rows, columns=["shard", "seq", "offset", "length", "doc_id", "start", "n_tokens", "ids_crc32"])
                yield out.astype({"doc_id": "Int64"})

    return shard_files(spark, path).mapInPandas(listed, INDEX)


def with_starts(listed: DataFrame) -> DataFrame:
    """``start`` counted over all shards: one row per shard is summed up, not one per record."""
    per = listed.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = per.select(F.col("shard"), F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return listed.join(before, "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")


def read_shuffled(spark: SparkSession, path: str, listed: DataFrame, seed: int) -> DataFrame:
    """doc_id and ids of all records, in a random order that the seed fixes. Shards are opened whole, records cut out by the index."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [unpack(next(frames(bytes(c)[o : o + n]))[1]) for c, at in zip(b.content, b["at"], strict=True) for o, n in ((x["offset"], x["length"]) for x in at)]
            yield pd.DataFrame({"doc_id": pd.array([r[0] for r in rows], "Int64"), "ids": [r[1].astype("i8") for r in rows]})

    at = listed.groupBy("shard").agg(F.collect_list(F.struct("offset", "length")).alias("at"))
    return shard_files(spark, path).join(at, "shard").mapInPandas(cut, "doc_id long, ids array<long>").orderBy(F.xxhash64("doc_id", F.lit(seed)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    scratch = Scratch(spark, "records")
    out = scratch.path("shards")
    write(spark, table(spark, sf_dir, "documents"), out, tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    listed = scratch.write(index(spark, out), "index")
    return with_starts(listed).select("doc_id", "start", "n_tokens", "ids_crc32")
