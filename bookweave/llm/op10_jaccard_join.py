"""N-gram Jaccard join with count-vector R-trees.

A document's set are its distinct n-word shingles, by 64-bit hash. Two documents link when their Jaccard similarity is
at least ``num / den``. The join is exact:

1. Documents with equal sets form a class, by a 128-bit fingerprint; only one of a class goes on.
2. Linked sets x, y with |x| <= |y| differ in at most D = |x| (den - num) / num shingles. Shingles are hashed into D + k
   groups, so that at least k groups are equal in both. A set with fewer than k poor groups (of ``cut`` shingles or
   fewer) sends its rich groups only, for one of the equal ones is rich; a set with more sends all. Sizes are banded
   (D is taken for the top of the band; a set near the lower end also visits the band below), and each (band, group,
   content) is a key. Equal keys make candidate edges to the smallest document of the key, never all pairs; the
   connected components of these edges are cells, and linked documents share a cell.
3. Passages that many documents share chain unrelated texts into large cells, in a large table most of all texts. A
   document of a cell larger than a block stays only if enough of its shingles (``num / den``, as a link needs) occur
   again in that cell; the others link with nothing there. They are told from the texts, by one slice of the shingles
   after the other, before any sets are written: who lacks too many goes at once, so neither the sets nor the shingles
   of all texts are on disk at a time. Those that stay are keyed again within their cell, by other groups, into smaller
   cells; and so on while that takes half of their rows or more out of large cells.
4. In a cell each document is a point: its shingle counts by hash group. An R-tree over the points bounds the overlap
   with a whole node by the sum of the smaller coordinates; surviving pairs are verified on the sets themselves.
   join() verifies all of them; for components alone, pairs that links already connect are skipped. Cells still larger
   than a block are first cut by the points alone into what the bound connects.

The keys of a batch of documents are reduced to one entry per key before they are sent, so a frequent passage or a
large group of copies sends one entry per batch, not per document. They travel packed, 16 bytes an entry. Cells larger
than a block are cut into blocks: first each block together with the cell's hubs, then only blocks with documents that
the hubs didn't connect against all others. No task gets more than two blocks, nothing is collected on the driver.

Defined results: documents without words (or null) have an empty set, link with nothing and are their own component;
a null doc_id links with nothing and has a null component; rows with the same doc_id are one node, links of any of
their texts count; fewer words than n are one shingle; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, bounded, byte_words, parallel, pieces, release, table
from .components import components
from .hashing import STEP, U, mixed, shingles

PIECE = 4 << 20  # bytes of stored text whose keys go to one piece
HELD = 1 << 18  # shingles whose keys are met in a mapper before they are sent
BLOCK, HUBS = 128, 8
SHIPPED = 1 << 17  # documents, copies included, that pairs of blocks take to one shuffle
POINTS = 4096  # documents of a block when only points are compared
GROUPS, LEAF = 64, 16  # coordinates of a point, points in a leaf
EMPTY = U(0x5EED)
SLICES = 4  # of the shingles of large cells; only one is on disk at a time
SHRINK = 0.5  # large cells are keyed again while at most this share of their rows is left in large cells


def layout(hi: int, lo: int, num: int, den: int) -> tuple[int, int, int]:
    """(D, k, cut) of a band. Any k and cut give exact results; these make sets with k or more poor groups rare."""
    d, best = hi * (den - num) // num, None
    for cut in range(3):
        k = 1
        for _ in range(12):  # towards the number of poor groups that is rarely exceeded
            mean = lo / (d + k)
            poor = (d + k) * math.exp(-mean) * sum(mean**i / math.factorial(i) for i in range(cut + 1))
            k = min(int(poor + 2 * math.sqrt(poor) + 0.1) + 1, 2 * d + 2)
        if best is None or k <= max(4, d // 3):
            best = (d, k, cut)
    return best


@cache
def bands(num: int, den: int) -> np.ndarray:
    """Where size bands start. Neighbours stand as far apart as linked sizes can, so a linked pair is in one or two neighbouring bands."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, starts[-1] * den // num))
    return np.array(starts, "i8")


@cache
def layouts(num: int, den: int) -> np.ndarray:
    starts = bands(num, den).tolist()
    return np.array([layout(hi - 1, lo, num, den) for lo, hi in pairwise(starts)], "i8")


def keys(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets and, for each key, the index of its set."""
    size = np.array([len(s) for s in sets], "i8")
    starts_at, table = bands(num, den), layouts(num, den)
    band = np.searchsorted(starts_at, size, "right") - 1
    found, owners = [], []
    for step in (0, 1):
        own = band - step
        hi = np.where(own >= 0, starts_at[np.maximum(own, 0) + 1] - 1, 0)
        d, k, cut = table[np.maximum(own, 0)].T
        use = np.flatnonzero((own >= 0) & (d > 0) & (size > 0) & ((step == 0) | (num * size <= den * hi)))
        if not len(use):
            continue
        groups = (d + k)[use]
        base = np.cumsum(groups) - groups
        n = size[use]
        h = np.concatenate([sets[i] for i in use])
        at = np.repeat(base, n) + (mixed(h + STEP) % np.repeat(groups.astype("u8"), n)).astype("i8")
        order = np.argsort(at, kind="stable")
        at, h = at[order], mixed(h)[order]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        total = int(groups.sum())
        content, filled = np.full(total, EMPTY, "u8"), np.zeros(total, "i8")
        content[at[starts]] = np.add.reduceat(h, starts)
        filled[at[starts]] = np.diff(np.append(starts, len(h)))
        owner = np.repeat(np.arange(len(use)), groups)
        group = np.arange(total) - base[owner]
        key = mixed(mixed(content) + STEP * (group.astype("u8") + (own[use][owner].astype("u8") << U(40))))
        poor = filled <= cut[use][owner]
        sure = np.bincount(owner, poor, len(use)) < groups - np.minimum(size, hi)[use] * (den - num) // num
        send = ~(poor & sure[owner])
        found.append(key[send])
        owners.append(use[owner[send]])
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, "u8"), np.zeros(0, "i8"))


def stars(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per key (its smallest document), and distinct edges from it to the key's other documents."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    hub = doc[first][np.cumsum(first) - 1] if len(key) else doc
    rest = hub != doc
    edges = np.unique(np.stack([hub[rest], doc[rest]], 1), axis=0) if rest.any() else np.zeros((0, 2), "i8")
    return key[first], doc[first], edges


FOUND = "kind int, piece int, a long, b long, n long, fp1 long, fp2 long, pack binary"


def _rows(kind: int, **columns) -> pd.DataFrame:
    n = len(next(iter(columns.values())))
    blank = {"kind": np.full(n, kind, "i4"), "piece": np.zeros(n, "i4"), **{c: np.zeros(n, "i8") for c in ("a", "b", "n", "fp1", "fp2")}, "pack": [None] * n}
    return pd.DataFrame(blank | columns)


def _columns(held: list) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    return np.array([d for d, _, _ in held], "i8"), [s for _, s, _ in held], np.array([f for _, _, f in held], "i8")


def _print(shingles: np.ndarray) -> np.ndarray:
    """A set's fingerprint, 128 bits."""
    return np.array([mixed(shingles).sum(dtype="u8"), mixed(shingles ^ STEP).sum(dtype="u8")], "u8").view("i8")


def _packed(key: np.ndarray, ident: np.ndarray, parts: int, *, flagged: bool = False, kind: int = 2) -> Iterator[pd.DataFrame]:
    """Entries (key, ident) by piece of the key space. A key's lowest bit may be a flag, which deals nothing out."""
    piece = ((key >> U(flagged)) % U(parts)).astype("i4")
    order = np.argsort(piece, kind="stable")
    if len(order):
        cuts = np.flatnonzero(np.concatenate([[True], piece[order][1:] != piece[order][:-1]]))
        packs = [np.stack([key[o], ident[o].view("u8")]).tobytes() for o in np.split(order, cuts[1:])]
        yield _rows(kind, piece=piece[order][cuts], pack=packs)


def _sent(key: np.ndarray, ident: np.ndarray, parts: int) -> Iterator[pd.DataFrame]:
    """One entry per key of a batch, and the edges that the batch itself shows (kind 1)."""
    key, ident, edges = stars(key, ident)
    if len(edges):
        yield _rows(1, a=edges[:, 0], b=edges[:, 1], piece=(edges[:, 1] % parts).astype("i4"))
    yield from _short(key, ident, parts)


def _short(key: np.ndarray, ident: np.ndarray, parts: int) -> Iterator[pd.DataFrame]:
    """Entries (key, ident) by piece of the key space, in 9 bytes as a rule in place of 16 (kind 2).

    Of a key, 40 bits besides its piece; keys that agree in these make candidates more, which are verified like all. Of
    an ident, its distance from the smallest in the pack.
    """
    piece = (key % U(parts)).astype("i4")
    order = np.argsort(piece, kind="stable")
    if len(order):
        cuts = np.flatnonzero(np.concatenate([[True], piece[order][1:] != piece[order][:-1]]))
        packs = []
        for o in np.split(order, cuts[1:]):
            own, least = ident[o], ident[o].min()
            wide = 4 if int(own.max()) - int(least) < 1 << 32 else 8
            far = (own.view("u8") - least.view("u8")).astype(f"<u{wide}")
            packs.append(least.tobytes() + bytes([wide]) + (key[o] // U(parts)).astype("<u8").view("u1").reshape(-1, 8)[:, :5].tobytes() + far.tobytes())
        yield _rows(2, piece=piece[order][cuts], pack=packs)


def _long(packs) -> tuple[np.ndarray, np.ndarray]:
    """Keys (of one piece) and idents of _short()'s packs."""
    keys, idents = [np.zeros(0, "u8")], [np.zeros(0, "i8")]
    for p in packs:
        wide = p[8]
        n = (len(p) - 9) // (5 + wide)
        key = np.zeros((n, 8), "u1")
        key[:, :5] = np.frombuffer(p, "u1", 5 * n, 9).reshape(n, 5)
        keys.append(key.view("<u8").ravel())
        idents.append((np.frombuffer(p, f"<u{wide}", n, 9 + 5 * n).astype("u8") + np.frombuffer(p, "u8", 1)).view("i8"))
    return np.concatenate(keys), np.concatenate(idents)


def _signed(n: int, num: int, den: int, parts: int):
    """Per document a row of kind 0 (set size, fingerprint), edges of kind 1, and packed keys by piece of kind 2."""

    def sent(docs: np.ndarray, sets: list[np.ndarray], fp: np.ndarray) -> Iterator[pd.DataFrame]:
        one = np.unique(fp, axis=0, return_index=True)[1]
        key, owner = keys([sets[i] for i in one], num, den)
        yield from _sent(key, docs[one][owner], parts)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, np.ndarray, tuple[int, int]]] = []  # of so many shingles that memory stays bounded
        size = 0
        for b in batches:
            known, docs = b.known.to_numpy(bool), b.doc_id.to_numpy("i8")
            sizes, prints = np.zeros(len(docs), "i8"), np.zeros((len(docs), 2), "i8")
            for i, t in enumerate(b.text):
                s = shingles([w.lower() for w in byte_words(t)], n)
                sizes[i] = len(s)
                prints[i] = _print(s)
                if known[i] and len(s):
                    held.append((docs[i], s, tuple(prints[i])))
                    size += len(s)
                if size >= HELD:
                    yield from sent(*_columns(held))
                    held, size = [], 0
            yield _rows(0, a=docs, n=sizes, fp1=prints[:, 0], fp2=prints[:, 1], piece=(np.arange(len(docs)) % parts).astype("i4")).assign(kind=np.where(known, 0, 3).astype("i4"))
        if held:
            yield from sent(*_columns(held))
        release()

    return sign


def _met(f: pd.DataFrame) -> pd.DataFrame:
    """All entries of a piece of the key space: edges between documents with equal keys. Other rows pass through."""
    release()
    rest = f[f.kind != 2]
    edges = stars(*_long(f["pack"][f.kind == 2]))[2]
    return pd.concat([rest, _rows(1, a=edges[:, 0], b=edges[:, 1])]) if len(edges) else rest


def _some(b: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """row, cell and sets of a batch, about HELD shingles at a time."""
    rows, cells, sets = b.row.to_numpy("i8"), b.cell.to_numpy("i8").view("u8"), [np.frombuffer(x, "u8") for x in b["set"]]
    upto = np.cumsum([len(x) for x in sets]) // HELD
    for own in np.split(np.arange(len(sets)), np.flatnonzero(np.diff(upto)) + 1):
        yield rows[own], cells[own], [sets[i] for i in own]


def _entries(rows: np.ndarray, cells: np.ndarray, sets: list[np.ndarray], parts: int) -> Iterator[pd.DataFrame]:
    """Distinct (cell, shingle) of some rows, packed by piece (kind 2), and how many shingles of a row they repeat among
    themselves, packed by the row's piece (kind 3).

    An entry's lowest bit says that the shingle is known to be repeated and its row was counted for it.
    """
    n = [len(x) for x in sets]
    key = mixed(np.concatenate(sets) + np.repeat(cells, n) * STEP) >> U(1)
    row = np.repeat(rows, n)
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[order]
    head = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    again = ~head | np.append(~head[1:], False) if len(key) else head
    counted, count = np.unique(row[again], return_counts=True)
    if len(counted):
        yield from _packed(counted.view("u8"), count, parts, kind=3)
    yield from _packed(key[head] << U(1) | again[head].astype("u8"), row[head], parts, flagged=True)


def _told(parts: int):
    """What _entries() has of each batch."""

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rows, cells, sets in _some(b):
                yield from _entries(rows, cells, sets, parts)
        release()

    return tell


def _told_of_texts(n: int, turn: int, parts: int):
    """What _entries() has of one slice of the texts' shingles; its size counts against a row (kind 3)."""

    def sent(held: list) -> Iterator[pd.DataFrame]:
        rows, cells, sets = np.array([r for r, _, _ in held], "i8"), np.array([c for _, c, _ in held], "i8").view("u8"), [s for _, _, s in held]
        yield from _packed(rows.view("u8"), -np.array([len(s) for s in sets], "i8"), parts, kind=3)
        yield from _entries(rows, cells, sets, parts)

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            for row, cell, text, *fp in b[["row", "cell", "text", "fp1", "fp2"]].itertuples(index=False, name=None):
                s = shingles([w.lower() for w in byte_words(text)], n)
                # of an id with several texts, the one that the row's fingerprint names
                if tuple(_print(s)) == tuple(fp):
                    held.append((row, cell, s[s % U(SLICES) == turn]))
                    size += len(held[-1][2])
                if size >= HELD:
                    yield from sent(held)
                    held, size = [], 0
        if held:
            yield from sent(held)
        release()

    return tell


def _unpacked(packs) -> np.ndarray:
    found = [np.frombuffer(p, "u8").reshape(2, -1) for p in packs]
    return np.concatenate(found, 1) if found else np.zeros((2, 0), "u8")


def _repeated(parts: int):
    """A piece of the (cell, shingle) space: per row the number of its shingles that occur in another row of the cell, packed by the row's piece."""

    def repeated(f: pd.DataFrame) -> pd.DataFrame:
        release()
        key, row = _unpacked(f["pack"][f.kind == 2])
        key, known = key >> U(1), (key & U(1)).astype(bool)
        _, group, met = np.unique(key, return_inverse=True, return_counts=True)
        many = (met > 1) | (np.bincount(group, known, len(met)) > 0)
        row, count = np.unique(row[many[group] & ~known], return_counts=True)
        return pd.concat([f[f.kind == 3], *_packed(row, count, parts, kind=3)])

    return repeated


def _summed(f: pd.DataFrame) -> pd.DataFrame:
    """A piece of the rows: the sum of each one's counts, one row each."""
    row, count = _unpacked(f["pack"])
    row, at = np.unique(row, return_inverse=True)
    return _rows(1, a=row.view("i8"), n=np.bincount(at, count.view("i8").astype("f8"), len(row)).astype("i8"))


def _keyed_again(num: int, den: int, parts: int, salt: int):
    """Edges and packed keys as in _signed, of rows within their cells; ``salt`` makes other groups of the shingles."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rows, cells, sets in _some(b):
                key, owner = keys([mixed(x ^ U(salt)) for x in sets], num, den)
                yield from _sent(mixed(key + cells[owner] * STEP), rows[owner], parts)
        release()

    return sign


class RTree:
    """Points are shingle counts by group. Bulk-loaded by size and then by the widest coordinate; two levels are enough for a block."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        leaves: list[np.ndarray] = []

        def cut(own: np.ndarray) -> None:
            if len(own) <= LEAF:
                leaves.append(own)
                return
            p = points[own]
            axis = int(np.ptp(p, axis=0).argmax())
            own = own[np.argsort(p[:, axis], kind="stable")]
            cut(own[: len(own) // 2])
            cut(own[len(own) // 2 :])

        cut(order)
        self.leaves, self.points, self.sizes = leaves, points, sizes
        self.top = np.stack([points[o].max(0) for o in leaves])
        self.least = np.array([sizes[o].min() for o in leaves])

    def near(self, x: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Points whose overlap with x can reach the threshold, those with the largest bound first."""
        # den * overlap >= num * union  <=>  (num + den) * overlap >= num * (|x| + |y|)
        open_ = (num + den) * np.minimum(x, self.top).sum(1) >= num * (size + self.least)
        own = [self.leaves[i] for i in np.flatnonzero(open_)]
        if not own:
            return np.zeros(0, "i8")
        at = np.concatenate(own)
        bound = np.minimum(x, self.points[at]).sum(1)
        keep = (num + den) * bound >= num * (size + self.sizes[at])
        return at[keep][np.argsort(-bound[keep], kind="stable")]


def point(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles >> U(7)).astype("i8") % GROUPS, minlength=GROUPS).astype("i4")


def linked(nodes: np.ndarray, points: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray] | None, group: np.ndarray, num: int, den: int, *, every_pair: bool = False) -> list[tuple[int, int]]:
    """Links among the documents of a block or two; without sets, what the bound allows. group: what is connected already."""
    tree = RTree(points, sizes)
    _, root = np.unique(group, return_inverse=True)
    found = []
    for i in range(len(nodes)):
        at = tree.near(points[i], sizes[i], num, den)
        at = at[(at < i) & (nodes[at] != nodes[i])]
        if not every_pair:
            at = at[root[at] != root[i]]
        if sets is None:
            roots, first = np.unique(root[at], return_index=True)
            found += [(int(nodes[i]), int(nodes[j])) for j in at[first]]
            root[np.isin(root, roots)] = root[i]
            continue
        while len(at):
            j, at = at[0], at[1:]
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if den * both >= num * (sizes[i] + sizes[j] - both):
                found.append((int(nodes[i]), int(nodes[j])))
                root[root == root[j]] = root[i]
                if not every_pair:
                    at = at[root[at] != root[i]]
    return found


def _verify(num: int, den: int, *, every_pair: bool = False, by_points: bool = False):
    def verify(f: pd.DataFrame) -> pd.DataFrame:
        f = f.drop_duplicates(["node", "fp1", "fp2"])
        sets = None if by_points else [np.frombuffer(s, "u8") for s in f["set"]]
        points = np.stack([np.frombuffer(p, "i4") for p in f.point])
        rows = linked(f.node.to_numpy("i8"), points, points.sum(1).astype("i8"), sets, f.group.to_numpy("i8"), num, den, every_pair=every_pair)
        return pd.DataFrame(rows, columns=["a", "b"], dtype="i8")

    return verify


SETS = "row long, cell long, node long, fp1 long, fp2 long, size long, set binary, point binary"
LINKS = "a long, b long"


def _with_sets(n: int):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [shingles([w.lower() for w in byte_words(t)], n) for t in b.text]
            # of an id with several texts, the one that the row's fingerprint names
            own = np.array([tuple(_print(s)) == p for s, p in zip(found, zip(b.fp1, b.fp2, strict=True), strict=True)], bool)
            out = b.drop(columns="text").assign(size=np.array([len(s) for s in found], "i8"), set=[s.tobytes() for s in found], point=[point(s).tobytes() for s in found])
            yield out[own].drop_duplicates("row")
        release()

    return sets


def _blocked(scratch: Scratch, rows: DataFrame, block: int) -> DataFrame:
    """rows(row, cell, ...) with the number of blocks of their cell and their own block; cells of one row go."""
    counted = scratch.write(rows.groupBy("cell").agg(F.count("*").alias("m")).filter("m > 1").withColumn("blocks", F.ceil(F.col("m") / block).cast("int")).drop("m"), "cells")
    return rows.join(bounded(counted), "cell").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))


def join(spark: SparkSession, docs: DataFrame, *, n: int = 5, num: int = 8, den: int = 10, every_pair: bool = True, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, links): doc_id, n_shingles, fp1, fp2, rep for each row, and verified links (a, b) between reps.

    ``rep`` is the smallest doc_id with the same set. Each linked pair of reps is a link; without every_pair, only as
    many as span the components.
    """
    if not den > num > 0:
        raise ValueError("the threshold must be above 0 and below 1")
    scratch = scratch or Scratch(spark, "jaccard")
    texts = parallel(spark, docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text"))
    parts = pieces(spark, docs, PIECE)
    signed = texts.mapInPandas(_signed(n, num, den, parts), FOUND)
    found = scratch.write(signed.groupBy("piece").applyInPandas(_met, FOUND).drop("pack", "piece"), "found")
    scratch.tidy()
    rows = found.filter("kind in (0, 3)").select(F.when(F.col("kind") == 0, F.col("a")).alias("doc_id"), F.col("n").alias("n_shingles"), "fp1", "fp2")
    # a third of all rows may be copies: the class table is written, so that the join with it can split them
    classes = scratch.write(rows.filter("n_shingles > 0 and doc_id is not null").groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep")), "classes")
    known = rows.join(classes, ["fp1", "fp2"], "left").select("doc_id", "n_shingles", "fp1", "fp2", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("rep")).alias("rep"))
    known = scratch.write(known, "documents")
    cells = components(scratch, found.filter("kind = 1").select("a", "b")).select(F.col("node").alias("doc_id"), F.col("label").alias("cell"))
    scratch.drop(found)
    scratch.tidy()
    # one document of each class in a cell, where a cell has two classes or more
    delegates = known.filter("rep is not null").join(bounded(cells), "doc_id").groupBy("cell", "fp1", "fp2").agg(F.min("doc_id").alias("doc_id"), F.min("rep").alias("node"), F.min("n_shingles").alias("size"))
    delegates = scratch.write(delegates.withColumn("row", F.xxhash64("cell", "fp1", "fp2")), "delegates")
    chosen = scratch.write(_blocked(scratch, delegates, BLOCK).select("doc_id", "row", "cell", "node", "fp1", "fp2", "size", "blocks"), "chosen")
    chosen = _able(scratch, docs, chosen, n, num, den, parts).select("doc_id", "row", "cell", "node", "fp1", "fp2")
    sets = docs.select("doc_id", "text").join(bounded(chosen), "doc_id").drop("doc_id").mapInPandas(_with_sets(n), SETS)
    sets = scratch.write(sets, "sets")
    scratch.tidy()
    sets = _split(scratch, _refined(scratch, sets, num, den, parts), num, den)
    verify = _verify(num, den, every_pair=every_pair)
    whole = sets.withColumn("group", F.col("node"))
    links = scratch.write(whole.filter("blocks = 1").groupBy("cell").applyInPandas(verify, LINKS), "links")
    scratch.tidy()
    large = whole.filter("blocks > 1")
    if large.isEmpty():
        return known, links
    if every_pair:
        pairs = _linked(scratch, large.withColumn("loose", F.lit(True)), verify)
        return known, links.unionAll(scratch.write(pairs.distinct(), "links"))
    # each block with the cell's hubs
    hubs = scratch.write(_hubs(large), "hubs")
    spread = hubs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(large.columns)
    first = scratch.write(large.unionAll(spread).groupBy("cell", "block").applyInPandas(verify, LINKS), "links")
    # the label that most documents of a cell have; all others are loose
    group = components(scratch, first).withColumnRenamed("node", "_node")
    labelled = scratch.write(large.select("row", "cell", "node").join(bounded(group), F.col("node") == F.col("_node"), "left").select("row", "cell", F.coalesce("label", "node").alias("label")), "labelled")
    main = scratch.write(labelled.groupBy("cell", "label").count().groupBy("cell").agg(F.max_by("label", F.struct("count", "label")).alias("main")), "main")
    loose = scratch.write(labelled.join(bounded(main), "cell").select("row", F.col("label").alias("group"), (F.col("label") != F.col("main")).alias("loose")), "loose")
    return known, links.unionAll(first).unionAll(_linked(scratch, large.drop("group").join(bounded(loose), "row"), verify))


def _able(scratch: Scratch, docs: DataFrame, chosen: DataFrame, n: int, num: int, den: int, parts: int) -> DataFrame:
    """chosen without the rows of large cells that can't link there: too many of their shingles occur in no other row that stays."""
    own = scratch.write(chosen.filter("blocks > 1").withColumn("lacks", F.lit(0).cast("long")), "large")
    for turn in range(SLICES):
        if own.isEmpty():
            break
        scratch.tidy()
        texts = docs.select("doc_id", "text").join(bounded(own.select("doc_id", "row", "cell", "fp1", "fp2")), "doc_id").drop("doc_id")
        told = texts.mapInPandas(_told_of_texts(n, turn, parts), FOUND)
        counts = told.groupBy("piece").applyInPandas(_repeated(parts), FOUND).groupBy("piece").applyInPandas(_summed, FOUND).select(F.col("a").alias("row"), F.col("n").alias("met"))
        left = own.join(counts, "row", "left").withColumn("lacks", F.col("lacks") - F.coalesce("met", F.lit(0)))
        own, old = scratch.write(left.filter(den * (F.col("size") - F.col("lacks")) >= num * F.col("size")).select(own.columns), "able"), own
        scratch.drop(old)
    scratch.tidy()
    return chosen.filter("blocks = 1").unionAll(own.drop("lacks").select(chosen.columns))


def _refined(scratch: Scratch, sets: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """sets with smaller cells: rows of large cells that can't link there go, the others are keyed again within their cell.

    Every round reads the rows of large cells alone. A shingle that a batch holds twice sends one entry of it, so a
    passage in a third of all documents stays small.
    """
    place, left, turn = scratch.write(sets.select("row", "cell", "size").distinct(), "placed"), None, 0
    while True:
        large = scratch.write(place.groupBy("cell").agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK), "large")
        now = large.agg(F.sum("m")).first()[0] or 0
        if not now or left is not None and now > SHRINK * left:
            break
        left, turn = now, turn + 1
        own = scratch.write(place.join(bounded(large.select("cell")), "cell").select("row", "cell", "size"), "own")
        told = sets.select("row", "set").join(bounded(own), "row").select("row", "cell", "set").mapInPandas(_told(parts), FOUND)
        counts = told.groupBy("piece").applyInPandas(_repeated(parts), FOUND).groupBy("piece").applyInPandas(_summed, FOUND).select(F.col("a").alias("row"), "n")
        able = scratch.write(own.join(counts, "row").filter(den * F.col("n") >= num * F.col("size")).select("row", "cell", "size"), "able")
        signed = sets.select("row", "set").join(bounded(able.select("row", "cell")), "row").mapInPandas(_keyed_again(num, den, parts, turn), FOUND)
        met = scratch.write(signed.groupBy("piece").applyInPandas(_met, FOUND).select("a", "b"), "met")
        label = components(scratch, met).select(F.col("node").alias("row"), F.col("label").alias("cell"))
        rest = place.join(bounded(large.select("cell")), "cell", "left_anti").select("row", "cell", "size")
        new = scratch.write(rest.unionAll(able.drop("cell").join(bounded(label), "row").select("row", "cell", "size")), "placed")
        for old in (place, own, able, met):
            scratch.drop(old)
        scratch.tidy()
        place = new
    return sets if not turn else sets.drop("cell").join(bounded(place.select("row", "cell")), "row")


def _split(scratch: Scratch, sets: DataFrame, num: int, den: int) -> DataFrame:
    """sets with blocks and block, after cells larger than a block are cut into what the bound on the points connects."""
    blocked = scratch.write(_blocked(scratch, sets.select("row", "cell", "node"), BLOCK), "blocked")
    large = scratch.write(blocked.filter("blocks > 1").select("row"), "large")
    if large.isEmpty():
        return sets.drop("cell").join(bounded(blocked.drop("node")), "row")
    points = _blocked(scratch, sets.drop("set").join(bounded(large), "row"), POINTS).withColumn("group", F.col("node")).withColumn("loose", F.lit(True)).withColumn("set", F.lit(None).cast("binary"))
    near = _linked(scratch, points, _verify(num, den, by_points=True), POINTS, "near")
    cut = components(scratch, near).select(F.col("node").alias("_node"), "label")
    again = blocked.join(bounded(large), "row", "left_semi").join(bounded(cut), F.col("node") == F.col("_node")).select("row", F.col("label").alias("cell"))
    again = _blocked(scratch, scratch.write(again, "again"), BLOCK).select("row", "cell", "blocks", "block")
    placed = scratch.write(blocked.filter("blocks = 1").select("row", "cell", "blocks", "block").unionAll(again), "placed")
    return sets.drop("cell").join(bounded(placed), "row")


def _hubs(large: DataFrame) -> DataFrame:
    """The HUBS documents of each large cell with the smallest hashes; partial aggregation keeps HUBS rows per task and cell."""
    order = Window.partitionBy("cell").orderBy(F.xxhash64("row"), "row")
    return large.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= HUBS).drop("_r")


def _pairs(scratch: Scratch, rows: DataFrame, block: int | None = None) -> tuple[DataFrame, int, int]:
    """rows with their pairs of blocks of a cell of which one at least has loose documents; how many copies of rows all pairs take; how many rows there are.

    Loose documents are dealt into blocks of their own, so that a few of them do not open all blocks.
    """
    counts = rows.groupBy("cell").agg(F.count("*").alias("m"), F.sum(F.col("loose").cast("int")).alias("n_loose"), F.bool_and("loose").alias("all_loose"), F.max("blocks").alias("most")).filter("n_loose > 0")
    counts = counts.withColumn("loose_blocks", F.ceil(F.col("n_loose") / (block or BLOCK)).cast("int"))
    counts = scratch.write(counts.withColumn("all_blocks", F.col("loose_blocks") + F.when(F.col("all_loose"), 0).otherwise(F.col("most"))), "counts")
    copies = F.col("n_loose") * F.col("all_blocks") + (F.col("m") - F.col("n_loose")) * F.col("loose_blocks")
    copies, there = counts.agg(F.coalesce(F.sum(copies), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
    rows = rows.join(bounded(counts.select("cell", "loose_blocks", "all_blocks")), "cell")
    rows = rows.withColumn("at", F.when(F.col("loose"), F.pmod(F.xxhash64("row"), F.col("loose_blocks")).cast("int")).otherwise(F.col("loose_blocks") + F.col("block")))
    # i is a block of loose documents; j any block from i on
    loose = F.sequence(F.lit(0), F.col("loose_blocks") - 1)
    ends = F.transform(loose, lambda i: F.struct(F.least(i, "at").alias("i"), F.greatest(i, F.col("at")).alias("j")))
    every = F.transform(F.sequence(F.lit(0), F.col("all_blocks") - 1), lambda j: F.struct(F.least("at", j).alias("i"), F.greatest(F.col("at"), j).alias("j")))
    return rows.withColumn("pairs", F.array_distinct(F.when(F.col("loose"), every).otherwise(ends))), copies, there


def _dealt(rows: DataFrame):
    """Groups (cell, i, j). Pairs are dealt out by themselves: a cell's pairs go to many tasks."""
    met = rows.withColumn("pair", F.explode("pairs")).select("cell", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"), "node", "fp1", "fp2", "set", "point", "group")
    return met.repartition("cell", "i", "j").groupBy("cell", "i", "j")


def _grid(scratch: Scratch, rows: DataFrame, block: int | None = None):
    """All pairs of blocks at a time."""
    return _dealt(_pairs(scratch, rows, block)[0])


def _linked(scratch: Scratch, rows: DataFrame, verify, block: int | None = None, name: str = "links") -> DataFrame:
    """What verify() finds in the pairs of blocks.

    A document goes along with each block that its own one meets, so copies grow with the square of a cell. The pairs
    take turns, each with some SHIPPED copies or as many as there are rows, if that is more; one turn's are on disk at a time.
    """
    rows, copies, there = _pairs(scratch, rows, block)
    turns, found = max(1, -(-copies // max(SHIPPED, there))), None
    for turn in range(turns):
        own = F.filter("pairs", lambda p: F.pmod(F.xxhash64("cell", p["i"], p["j"]), F.lit(turns)) == turn)
        new = scratch.write(_dealt(rows.withColumn("pairs", own)).applyInPandas(verify, LINKS), name)
        found = new if found is None else found.unionAll(new)
        scratch.tidy()
    return found


def classes(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_shingles, component_id for each row."""
    scratch = how.pop("scratch", None) or Scratch(spark, "jaccard")
    known, links = join(spark, docs, scratch=scratch, every_pair=False, **how)
    label = bounded(components(scratch, links).withColumnRenamed("node", "rep"))
    return known.join(label, "rep", "left").select("doc_id", "n_shingles", F.coalesce("label", "rep", "doc_id").alias("component_id"))


def degrees(known: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, rep and n_links for each row of join()'s documents: how many rows of other ids it links with, copies included.

    Counted per class, so copies are not expanded into pairs.
    """
    size = known.filter("rep is not null").groupBy("rep").agg(F.count("*").alias("copies"))
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    near = both.join(size.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("near"))
    counted = size.join(near, "rep", "left").select("rep", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return known.join(counted, "rep", "left").select("doc_id", "rep", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """docs with one document of each component, the one with the smallest doc_id; rows without words stay."""
    scratch, steps = Scratch(spark, "jaccard"), Scratch(spark, "jaccard-steps")
    found = scratch.write(classes(spark, docs, scratch=steps, **how), "components")
    steps.clear()
    gone = scratch.write(found.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    kept = docs.join(bounded(gone), "doc_id", "left_anti").select(docs.columns)
    again = scratch.write(found.filter("doc_id = component_id and n_shingles > 0").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    scratch.drop(found)
    scratch.tidy()
    if again.isEmpty():
        return kept
    # rows that share an id: one of them
    one = docs.join(bounded(again), "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return kept.join(bounded(again), "doc_id", "left_anti").select(docs.columns).unionAll(one)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark, table(spark, sf_dir, "documents"), n=3, num=90, den=100)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] END) AS g FROM d),
n AS (SELECT doc_id, len(g)::BIGINT AS n FROM s),
e AS (SELECT doc_id, hash(unnest(g)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 90 * (x.n + y.n - met)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, b AS other FROM u UNION SELECT r.node, u.b FROM r JOIN u ON u.a = r.other),
c AS (SELECT node, min(other) AS least FROM r GROUP BY node)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(c.least, doc_id)) AS component_id FROM n LEFT JOIN c ON node = doc_id
"""
