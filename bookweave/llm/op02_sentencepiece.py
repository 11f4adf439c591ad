"""SentencePiece encoding and decoding with exact N-best segmentation.

A text is a lattice of vocabulary pieces; a segmentation's score is the sum of its pieces' scores, as in a unigram
model. Forward Viterbi gives the best score from the start to each position, which is an exact heuristic for an A-star
search from the end backwards: hypotheses leave the queue in order of their final score. Ties are ordered by the ids
compared from the last piece backwards.

No piece crosses from other characters into the white-space mark, and some characters (the line feed) are in no piece,
so the lattice falls into chunks, and these into parts between characters that are neighbours in no piece; both recur
all over a corpus. Workers remember each one's best segmentation and its gap to the second best. The N best of a document
then differ from its best in at most N-1 chunks, those with the smallest gaps (earlier ones first among equals), and an
A-star search over these chunks' own N-best lists combines them; long chunks are put together from their parts in the
same way. Ties between documents' segmentations are ordered by the chunks' ranks compared from the last chunk backwards.

A part longer than ``SHORT`` characters is searched by sidetracks: a hypothesis is a segmentation that follows its
parent's back to some place and Viterbi's best from there, so its whole score is known when it is queued and only N are
kept; memory is some 40 bytes a character. There, ties are ordered by where they leave their parent, from the end.

Normalisation is the identity with a dummy space in front; characters without a piece become byte pieces. Decoding is
exact, except that the white-space mark U+2581 itself decodes to a space, as the format has it.

Defined results: null and empty texts have no pieces, score 0 and one segmentation; repeated rows are encoded alike;
memory is bounded by the memo (``MEMO`` chunks) and one document; an empty table gives an empty result; extra columns
are ignored by segment() and kept by encode(), those called ids or n_tokens under the next free name (ids_, n_tokens_).
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import free, map_rows, parallel, table

MARK = "▁"
MEMO, LONGEST = 80_000, 48  # some 0.3 KB an entry; four such generations at most
LISTS = 20_000  # chunks whose N best are remembered
SHORT = 256  # characters of a part whose hypotheses may hold their ids
UNKNOWN_PENALTY = 10.0  # below the smallest score of the vocabulary
NBEST = 4

Edge = tuple[int, tuple[int, ...], float]  # from, ids, score


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes = [0] * 256
        self.surface: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.surface.append(b"")
            else:
                self.pieces[piece] = (i, sp.get_score(i))
                self.surface.append(piece.replace(MARK, " ").encode())
        #: Every beginning of a piece, with the piece if it is one.
        self.beginnings: dict[str, tuple[int, float] | None] = {p[:k]: None for p in self.pieces for k in range(1, len(p))}
        self.beginnings |= self.pieces
        self.pairs = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.longest = max(map(len, self.pieces))
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError("a piece holds the white-space mark after other characters")
        # without a piece that holds a line feed, line feeds cut the lattice as well
        cut = MARK if any("\n" in p for p in self.pieces) else MARK + "\n"
        self.chunks = re.compile(f"{MARK}*[^{cut}]+|{MARK}+|\n").findall

    def edges(self, chunk: str) -> list[list[Edge]]:
        """By end position, the pieces that end there. A character without a piece of its own is an unknown edge of bytes."""
        out: list[list[Edge]] = [[] for _ in range(len(chunk) + 1)]
        get, longest = self.pieces.get, self.longest
        for i in range(len(chunk)):
            for j in range(i + 1, min(len(chunk), i + longest) + 1):
                if found := get(chunk[i:j]):
                    out[j].append((i, (found[0],), found[1]))
                elif j == i + 1:
                    out[j].append((i, tuple(self.bytes[b] for b in chunk[i].encode("utf-8", "surrogatepass")), self.unknown))
        return out

    def forward(self, edges: list[list[Edge]]) -> list[float]:
        best = [0.0]
        for own in edges[1:]:
            best.append(max(best[i] + s for i, _, s in own))
        return best

    def nbest(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """(score, ids) of the n best segmentations: A-star from the end, the forward scores as heuristic."""
        if len(chunk) > SHORT:
            return self.sidetracked(chunk, n)
        edges = self.edges(chunk)
        forward = self.forward(edges)
        queue: list[tuple[float, tuple, int, float]] = [(-forward[-1], (), len(chunk), 0.0)]
        found = []
        while queue and len(found) < n:
            _, back, at, score = heapq.heappop(queue)
            if not at:
                found.append((score, tuple(i for ids in reversed(back) for i in ids)))
                continue
            for i, ids, s in edges[at]:
                heapq.heappush(queue, (-(forward[i] + s + score), (*back, ids), i, s + score))
        return found

    def edges_to(self, chunk: str, j: int) -> Iterator[tuple[int, int, float]]:
        """(from, id or -1 for bytes, score) of the pieces that end at j."""
        for i in range(max(0, j - self.longest), j):
            if found := self.pieces.get(chunk[i:j]):
                yield i, found[0], found[1]
            elif i == j - 1:
                yield i, -1, self.unknown

    def ids_of(self, chunk: str, at: int, piece: int) -> list[int]:
        return [piece] if piece >= 0 else [self.bytes[b] for b in chunk[at].encode("utf-8", "surrogatepass")]

    def sidetracked(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """nbest() of a long part. A hypothesis: (loss, its parent, where it leaves the parent's way, the edge taken there)."""
        first, _, piece, start = self.viterbi(chunk)
        queue: list[tuple] = [(0.0, 0, 0, 0, 0, None)]
        found: list[tuple] = []
        while queue and len(found) < n:
            hypothesis = heapq.heappop(queue)
            found.append(hypothesis)
            loss, at = hypothesis[0], hypothesis[4] if hypothesis[5] else len(chunk)

            def aside(at=at, loss=loss, turn=len(found)):
                """What leaves this way behind the place where it became its own: nearest to the end first."""
                while at:
                    for i, ident, score in self.edges_to(chunk, at):
                        if (i, ident) != (start[at], piece[at]):
                            yield loss + first[at] - (first[i] + score), turn, len(chunk) - at, ident, i, (hypothesis, at)
                    at = start[at]

            left = n - len(found)
            queue = heapq.nsmallest(left, heapq.merge(sorted(queue, key=_order), heapq.nsmallest(left, aside(), key=_order), key=_order), key=_order)
        return [self._spelled(chunk, h, piece, start) for h in found]

    def _spelled(self, chunk: str, hypothesis: tuple, piece, start) -> tuple[float, tuple[int, ...]]:
        """Score and ids of a hypothesis, its way followed from the end."""
        turns = {}
        while hypothesis[5]:
            parent, at = hypothesis[5]
            turns[at] = (hypothesis[4], hypothesis[3])
            hypothesis = parent
        at, back, total = len(chunk), [], 0.0
        while at:
            i, ident = turns.get(at) or (start[at], piece[at])
            back.extend(reversed(self.ids_of(chunk, i, ident)))
            total = (self.unknown if ident < 0 else self.pieces[chunk[i:at]][1]) + total
            at = i
        return total, tuple(reversed(back))

    def best(self, chunk: str) -> tuple[float, float, list[int]]:
        """Best score, gap to the second best (infinite if there is none), and the best's ids: forward Viterbi alone."""
        first, second, piece, start = self.viterbi(chunk)
        ids, at = [], len(chunk)
        while at:
            i = start[at]
            ids.extend([piece[at]] if piece[at] >= 0 else reversed(self.ids_of(chunk, i, -1)))
            at = i
        return first[-1], first[-1] - second[-1], ids[::-1]

    def viterbi(self, chunk: str) -> tuple:
        """By end position: best score, second best score, the best's last piece (-1: bytes), and where that begins."""
        n, get = len(chunk), self.beginnings.get
        first, second, piece, start = [-np.inf] * (n + 1), [-np.inf] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        if n > SHORT:  # the same, in less memory
            first, second, piece, start = array("d", first), array("d", second), array("i", piece), array("i", start)
        first[0] = 0.0
        for i in range(n):
            here, there = first[i], second[i]
            lone = True
            for j in range(i + 1, n + 1):
                found = get(chunk[i:j], 0)
                if found:
                    if j == i + 1:
                        lone = False
                    ident, own = found
                    score, old = here + own, first[j]
                    if score > old or score == old and ident < piece[j]:
                        first[j], piece[j], start[j] = score, ident, i
                        score = there + own
                        second[j] = old if old > score else score
                    elif score > second[j]:
                        second[j] = score
                elif found == 0:
                    break
            if lone:
                j, own = i + 1, self.unknown
                score, old = here + own, first[j]
                if score > old:
                    first[j], piece[j], start[j] = score, -1, i
                    score = there + own
                    second[j] = old if old > score else score
                elif score > second[j]:
                    second[j] = score
        return first, second, piece, start

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "surrogatepass")
        return text.removeprefix(" ")


def _order(hypothesis: tuple) -> tuple:
    return hypothesis[:4]


class _Memo(dict):
    """What has been worked out per chunk. When full, the entries become the older generation, from which those in use return."""

    def __init__(self, make, most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, chunk: str) -> tuple[float, float, bytes]:
        found = self.older.get(chunk) or self.make(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[chunk] = found
        return found


class Segmenter:
    """Documents, by way of memos of chunks and of their parts: (score, gap to the second best, ids)."""

    def __init__(self, path: str, memo: int = MEMO):
        self.vocabulary = Vocabulary(path)
        self.known, self.parts = _Memo(self._chunk, memo), _Memo(self._part, memo)
        self.lists: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}

    def _part(self, part: str) -> tuple[float, float, bytes]:
        score, gap, ids = self.vocabulary.best(part)
        return score, gap, np.array(ids, "<u4").tobytes()

    def _nbest(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Chunks with small gaps are mostly frequent words."""
        found = self.lists.get((chunk, n))
        if found is None:
            if len(self.lists) >= LISTS:
                self.lists.clear()
            found = self._parted(chunk, n) if len(chunk) > LONGEST else self.vocabulary.nbest(chunk, n)
            if len(chunk) <= LONGEST:
                self.lists[chunk, n] = found
        return found

    def _parted(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """A long chunk's n best, put together from its parts'."""
        parts = self._cut(chunk)
        if len(parts) == 1:
            return self.vocabulary.nbest(chunk, n)
        at = [self.parts[p] for p in parts]
        return [(score, tuple(ids.tolist())) for score, ids in self._joined(parts, at, n, self.vocabulary.nbest)]

    def _cut(self, chunk: str) -> list[str]:
        pairs = self.vocabulary.pairs
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in pairs]
        return [chunk[a:b] for a, b in pairwise((0, *cuts, len(chunk)))]

    def _chunk(self, chunk: str) -> tuple[float, float, bytes]:
        """No piece crosses two characters that stand side by side in none, so the chunk falls into parts there."""
        parts = self._cut(chunk)
        if len(parts) == 1:
            return self.parts[chunk]
        found = [self.parts[p] for p in parts]
        return sum(f[0] for f in found), min(f[1] for f in found), b"".join([f[2] for f in found])

    def __call__(self, text: str | None, n: int) -> list[tuple[float, np.ndarray]]:
        """The n best (score, ids) of a whole text."""
        if not text:
            return [(0.0, np.zeros(0, "<u4"))]
        chunks = self.vocabulary.chunks(MARK + text.replace(" ", MARK))
        return self._joined(chunks, list(map(self.known.__getitem__, chunks)), n, self._nbest)

    def _joined(self, chunks: list[str], at: list[tuple[float, float, bytes]], n: int, nbest: Callable) -> list[tuple[float, np.ndarray]]:
        """The n best of chunks side by side, from each one's (score, gap, ids)."""
        best, total = [a[2] for a in at], sum([a[0] for a in at])
        found = [(total, np.frombuffer(b"".join(best), "<u4"))]
        if n > 1:
            gap = np.array([a[1] for a in at])
            # the smallest gaps, among equal ones the earlier chunks
            limit = np.partition(gap, n - 2)[n - 2] if len(gap) > n - 1 else np.inf
            below = np.flatnonzero(gap < limit)
            places = sorted([*below, *np.flatnonzero(gap == limit)[: n - 1 - len(below)]])
            lists = [nbest(chunks[p], n) for p in places]
            for ranks in self._combined(lists, n)[1:]:
                own = list(best)
                loss = 0.0
                for p, r, options in zip(places, ranks, lists, strict=True):
                    own[p] = np.array(options[r][1], "<u4").tobytes()
                    loss += options[0][0] - options[r][0]
                found.append((total - loss, np.frombuffer(b"".join(own), "<u4")))
        return found

    @staticmethod
    def _combined(lists: list[list[tuple[float, tuple[int, ...]]]], n: int) -> list[tuple[int, ...]]:
        """Ranks of the n best choices of one option per chunk. Every best is loss 0, so the loss so far is the exact bound."""
        queue: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        found = []
        while queue and len(found) < n:
            loss, back = heapq.heappop(queue)
            if len(back) == len(lists):
                found.append(back[::-1])
                continue
            options = lists[len(lists) - 1 - len(back)]
            for r, (score, _) in enumerate(options):
                heapq.heappush(queue, (loss + options[0][0] - score, (*back, r)))
        return found


_segmenters: dict[tuple[str, int], Segmenter] = {}


def segmenter(path: str, memo: int = MEMO) -> Segmenter:
    """One per worker process, kept between tasks."""
    if (path, memo) not in _segmenters:
        _segmenters[path, memo] = Segmenter(path, memo)
    return _segmenters[path, memo]


def model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def segment(spark: SparkSession, docs: DataFrame, *, path: str, n: int = NBEST) -> DataFrame:
    """doc_id and, best first, segmentations: array of (score, ids); round_trip: the best decodes to the text."""

    def cut(part) -> dict:
        s, texts = segmenter(path), part.column("text").to_pylist()
        found = [s(t, n) for t in texts]
        same = [s.vocabulary.decode(f[0][1].tolist()) == (t or "").replace(MARK, " ") for f, t in zip(found, texts, strict=True)]
        return {"segmentations": [[{"score": x, "ids": i.tolist()} for x, i in f] for f in found], "round_trip": same}

    return map_rows(parallel(spark, docs.select("doc_id", "text")), cut, "segmentations array<struct<score: double, ids: array<int>>>, round_trip boolean", drop=("text",), step=64)


def encode(spark: SparkSession, docs: DataFrame, *, path: str) -> DataFrame:
    """docs without text, with ids of its best segmentation and n_tokens."""

    def cut(part) -> dict:
        s = segmenter(path)
        ids = [s(t, 1)[0][1].view("<i4") for t in part.column("text").to_pylist()]
        return {"ids": ids, "n_tokens": [len(i) for i in ids]}

    for c in [c for c in docs.columns if c.lower() in ("ids", "n_tokens")]:
        docs = docs.withColumnRenamed(c, free(c, docs))
    return map_rows(docs, cut, "ids array<int>, n_tokens long", drop=("text",))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number and checksum of the best segmentation's ids, the scores of the first and last of the N
    best, and how many there are."""
    path = model()

    def summed(part) -> dict:
        s, out = segmenter(path, 400_000), {"n_pieces": [], "ids_crc32": [], "best_score": [], "last_score": [], "n_best": [], "round_trip": []}
        for t in part.column("text").to_pylist():
            found = s(t, NBEST)
            ids = found[0][1]
            row = (len(ids), zlib.crc32(ids.tobytes()), found[0][0], found[-1][0], len(found), s.vocabulary.decode(ids.tolist()) == (t or "").replace(MARK, " "))
            for values, x in zip(out.values(), row, strict=True):
                values.append(x)
        return out

    docs = parallel(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return map_rows(docs, summed, "n_pieces long, ids_crc32 long, best_score double, last_score double, n_best int, round_trip boolean", drop=("text",))
