"""64-bit similarity fingerprints of texts (Charikar 2002) over character shingles."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SHINGLE_WIDTH


def simhash(text: str, width: int = SHINGLE_WIDTH) -> int:
    """Each bit is set if it is set in more than half of the shingles' hashes (low 8 bytes of MD5)."""
    t = re.sub(r"[^\w]+", "", text.lower())
    found = Counter(t[i : i + width] for i in range(max(1, len(t) - width + 1)))
    h = np.frombuffer(b"".join(hashlib.md5(s.encode()).digest()[8:] for s in found), np.uint8).reshape(-1, 8)
    weight = np.fromiter(found.values(), "f8", len(found))
    ones = weight @ np.unpackbits(h, axis=1)
    return int.from_bytes(np.packbits(ones > weight.sum() / 2).tobytes(), "big")


#: Characters whose shingles are hashed at a time, and met in one piece of a text.
HELD = 1 << 18
#: Slots of a worker's table of hashes, 16 bytes each.
SLOTS = 1 << 21
BITS = 9  # of a character's number in a shingle's key
_TURNS = np.array([7, 12, 17, 22, 5, 9, 14, 20, 4, 11, 16, 23, 6, 10, 15, 21], "u4").reshape(4, 4)
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_MASK = np.array([0, 0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], "u4")
_PAD = np.array([0, 0x80, 0x8000, 0x800000, 0x80000000, 0], "u4")


def md5_low(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Low 8 bytes of the MD5 of text[start:end], each of up to 55 bytes: one block, so all are hashed side by side."""
    text = np.concatenate([text, np.zeros(64, "u1")])
    at = np.ndarray(len(text) - 3, "<u4", text, strides=(1,))
    out = np.empty(len(start), "u8")
    for k in range(0, len(start), 1 << 13):
        own, n = start[k : k + (1 << 13)], (end - start)[k : k + (1 << 13)]
        word: list = [None] * 16
        for i in range(int(n.max()) // 4 + 1):
            left = np.clip(n - 4 * i, -1, 4) + 1
            word[i] = at[own + 4 * i] & _MASK[left] | _PAD[left]
        word[14] = (n * 8).astype("u4")
        a, b, c, d = (np.full(len(own), x, "u4") for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
        for i in range(64):
            if i < 16:
                f, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, g = c ^ (b | ~d), 7 * i % 16
            f += a
            f += _SINES[i]
            if word[g] is not None:
                f += word[g]
            turn = _TURNS[i // 16, i % 4]
            a, d, c, b = d, c, b, b + (f << turn | f >> np.uint32(32 - turn))
        c, d = (c + np.uint32(0x98BADCFE)).byteswap(), (d + np.uint32(0x10325476)).byteswap()
        out[k : k + (1 << 13)] = c.astype("u8") << np.uint64(32) | d
    return out


class _Hashes:
    """Hashes of shingles, worked out side by side. A shingle's key is its characters' numbers, 9 bits each, so that equal
    keys are equal shingles; recent ones' hashes are kept in a table. Characters beyond the first 511 have no number."""

    def __init__(self, width: int = SHINGLE_WIDTH):
        self.width, self.numbers, self.last = width, np.zeros(0x110000, "u2"), 0
        self.keys, self.found = np.zeros(SLOTS, "u8"), np.zeros(SLOTS, "u8")

    def known(self, points: np.ndarray) -> bool:
        if not self.numbers[points].all():
            new = np.unique(points[self.numbers[points] == 0])[: (1 << BITS) - 1 - self.last]
            self.numbers[new] = np.arange(self.last + 1, self.last + 1 + len(new))
            self.last += len(new)
        return bool(self.numbers[points].all())

    def of(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hashes of the shingles of known characters that begin at starts."""
        number = self.numbers[points].astype("u8")
        n = len(points) - self.width + 1
        key = number[:n].copy()
        for i in range(1, self.width):
            key = key << np.uint64(BITS) | number[i : n + i]
        key = key[starts]
        slot = (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype("i8")
        hashes = self.found[slot]
        missed = np.flatnonzero(self.keys[slot] != key)
        if len(missed):
            _, first, which = np.unique(key[missed], return_index=True, return_inverse=True)
            text = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), "u1")
            ends = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
            at = starts[missed[first]]
            new = md5_low(text, ends[at], ends[at + self.width])
            hashes[missed] = new[which]
            self.keys[slot[missed[first]]], self.found[slot[missed[first]]] = key[missed[first]], new
        return hashes


def _ones(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many hashes of each run, which begin at starts, have each bit set: 64 columns, the lowest bit first."""
    sizes = np.diff(np.append(starts, len(hashes)))
    parts = -(-sizes // 255)  # bytes count up to 255
    first = np.cumsum(parts) - parts
    run = np.repeat(np.arange(len(starts)), parts)
    cuts = starts[run] + 255 * (np.arange(len(run)) - first[run])
    out = np.empty((len(starts), 8, 8), "i8")
    for bit in range(8):
        lanes = np.add.reduceat(hashes >> np.uint64(bit) & np.uint64(0x0101010101010101), cuts)
        out[:, :, bit] = np.add.reduceat(lanes.view("u1").reshape(-1, 8).astype("i8"), first)
    return out.reshape(-1, 64)


_hashes: list[_Hashes] = []


def simhashes(texts: list[str | None]) -> list[str | None]:
    """simhash() of many texts, as text; null for blank ones. The same values; a text's memory does not grow with its shingles."""
    if not _hashes:
        _hashes.append(_Hashes())
    own, width = _hashes[0], SHINGLE_WIDTH
    out: list[str | None] = [None] * len(texts)
    ones, total = np.zeros((len(texts), 64), "i8"), np.zeros(len(texts), "i8")

    def pieces() -> Iterator[tuple[int, np.ndarray]]:
        for i, t in enumerate(texts):
            if t is None or not t.strip():
                continue
            c = "".join(re.findall(r"\w+", t.lower()))
            points = np.frombuffer(c.encode("utf-32-le"), "<u4")
            if len(points) < width or not own.known(points):
                out[i] = str(simhash(t))
                continue
            total[i] = len(points) - width + 1
            for k in range(0, total[i], HELD):
                yield i, points[k : k + HELD + width - 1]

    def count(held: list[tuple[int, np.ndarray]]) -> None:
        sizes = np.array([len(p) for _, p in held])
        begin = np.cumsum(sizes) - sizes
        n = sizes - width + 1
        first = np.cumsum(n) - n
        starts = np.arange(n.sum()) + np.repeat(begin - first, n)
        np.add.at(ones, [i for i, _ in held], _ones(own.of(np.concatenate([p for _, p in held]), starts), first))

    held, size = [], 0
    for piece in pieces():
        held.append(piece)
        size += len(piece[1])
        if size >= HELD:
            count(held)
            held, size = [], 0
    if held:
        count(held)
    for i in np.flatnonzero(total):
        out[i] = str(int.from_bytes(np.packbits(2 * ones[i] > total[i], bitorder="little").tobytes(), "little"))
    return out


def fingerprints(books: DataFrame, width: int = SHINGLE_WIDTH) -> DataFrame:
    """barcode, hash: the unsigned value as text; null for blank text. Arrow, because exploding shingles costs 17 times as much."""
    one = lambda t: None if t is None or not t.strip() else str(simhash(t, width))
    udf = F.pandas_udf(lambda s: pd.Series(simhashes(s.tolist()) if width == SHINGLE_WIDTH else [one(t) for t in s], dtype=object), "string")
    return books.select("barcode", udf("text").alias("hash"))
