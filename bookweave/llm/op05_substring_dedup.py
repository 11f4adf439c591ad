"""Substring dedup: suffix automata of reference shards, matching statistics, maximal repeated spans removed.

A window is ``window`` consecutive words. A word goes when some window over it has the same words as a window that
starts earlier (smaller doc_id, or same doc_id and smaller start). So some copy of every window stays.

Two references. against() takes a given one of bounded size: automata of its shards are broadcast, documents stream past
them for matching statistics, and maximal spans at or above the window go. For apply() and digest() the reference is the
corpus itself, so automata of all of it can't be broadcast: every task would need all words. It is cut into shards by
content instead, and documents send each shard only what can match there:

1. Each window has an anchor, its 8-word run with the smallest hash, so equal windows have equal anchors. Anchors
   (one in seven words) are met by hash; those that occur once end here.
2. For each anchor that occurs again a document sends the anchor's segment, the words under the windows that share it,
   to the anchor's shard. Of a hot anchor, one that more than ``HOT`` batches of documents hold, it sends the windows one
   by one instead, each to a shard of its own words, so that a phrase with many continuations is spread over all shards.
3. A shard takes the segments of an anchor in corpus order, which is that of (doc_id, place of the anchor), for equal
   windows have it at the same word. Segments equal to an earlier one are repeats as a whole. The others are streamed
   through a suffix automaton of the segments before them: where the matching statistic reaches the window, the window
   is a repeat. Then the segment joins the automaton. Segments at the same (doc_id, place) are not earlier than each
   other: all are compared, then all join.
4. Repeated windows return to their rows; the union of their words is cut out.

A row is told by a 64-bit hash of doc_id and text; doc_id alone only gives the order.

Anchors and segments that occur often are reduced within each batch of documents before they are sent (one entry per
batch; rows that tie with it follow without words), so a passage in a third of all documents stays small. What a batch
itself knows to be repeated goes by row: positions of anchors, and repeated windows with those that adjoin them as one
run, so a long passage is one run a document, not one of each anchor or window. All of it travels packed. Words count by a 64-bit hash in
steps 1 and 2 and by 48 bits of it within the segments of one anchor.

Defined results: null or empty text has no words; a null doc_id counts as the largest; rows that share a doc_id, and
those without one, are cut each by itself and ordered by start alone, so exact copies of a row keep the same words and
all stay; an empty table gives an empty result; extra columns are ignored by spans() and kept by apply().
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .automaton import SuffixAutomaton
from .common import Scratch, bounded, byte_words, free, map_rows, parallel, pieces, release, table, word_count
from .hashing import U, runs, word_ids

WINDOW, ANCHOR = 20, 8
PIECE = 2 << 20
CODE = 6  # bytes of a word within a segment
LAST = (1 << 63) - 1  # stands for a null doc_id
SENT = "kind int, piece int, row long, value long, anchor long, pack binary"
HOT = 256  # batches that hold an anchor; a batch has about CHUNK words
HEAD = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("at", "<i4"), ("row", "<i8"), ("start", "<i4"), ("n", "<i4")])  # n = 0: the words of the entry before
MET = np.dtype([("anchor", "<u8"), ("row", "<i8"), ("at", "<i4")])
FACT = np.dtype([("row", "<i8"), ("value", "<i8"), ("anchor", "<u8")])
CHUNK = 1 << 18  # words handled at a time


def segments(ids: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window start, last window start, anchor position, anchor hash) of each run of windows with one anchor.

    ids: word hashes of some documents one after the other; doc: which document each belongs to.
    """
    none = np.zeros(0, "i8")
    if len(ids) < window:
        return none, none, none, none.astype("u8")
    h = runs(ids, min(ANCHOR, window))
    span = window - min(ANCHOR, window) + 1
    at = np.lib.stride_tricks.sliding_window_view(h, span).argmin(1) + np.arange(len(ids) - window + 1)
    starts = np.flatnonzero(doc[: len(at)] == doc[window - 1 :])
    at = at[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (doc[starts[1:]] != doc[starts[:-1]])]) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    return starts[first], starts[last], at[first], h[at[first]]


def _chunks(texts: list, docs: np.ndarray) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, their word hashes end to end, the row of each word, and where each row begins; about CHUNK words at a time."""
    rows, ids, n = [], [], 0
    for i, t in enumerate(texts):
        rows.append(i)
        ids.append(word_ids(byte_words(t)))
        n += len(ids[-1])
        if n >= CHUNK or i == len(texts) - 1:
            sizes = np.array([len(x) for x in ids])
            yield rows, np.concatenate(ids), np.repeat(np.arange(len(rows)), sizes), np.cumsum(sizes) - sizes
            rows, ids, n = [], [], 0


def _packs(pack: list[bytes], piece: list[int], kind: int = 2) -> pd.DataFrame:
    """Rows of kind 2: packed entries for a piece. Kind 1: packed facts."""
    none = np.zeros(len(pack), "i8")
    return pd.DataFrame({"kind": np.full(len(pack), kind, "i4"), "piece": np.array(piece, "i4"), "row": none, "value": none, "anchor": none, "pack": pack})


def _told(row: np.ndarray, value: np.ndarray, pieces: int, anchor: np.ndarray | None = None) -> pd.DataFrame:
    """One thing known of a row each, and the anchor it is known by, packed by the row's piece (kind 1)."""
    facts = np.zeros(len(row), FACT)
    facts["row"], facts["value"] = row, value
    if anchor is not None:
        facts["anchor"] = anchor
    found = [(p, x.tobytes()) for p, (x,) in _by(row % pieces, facts)]
    return _packs([x for _, x in found], [p for p, _ in found], 1)


def _heard(f: pd.DataFrame) -> np.ndarray:
    """The facts that a piece was told."""
    return np.frombuffer(b"".join(f["pack"][f.kind == 1]), FACT)


def _facts(row: np.ndarray, value: np.ndarray, anchor: np.ndarray | None = None, *, kind: int = 1) -> pd.DataFrame:
    """Rows of kind 1: one thing known of a row each, and the anchor it is known by. Kind 3: hot anchors."""
    anchor = np.zeros(len(row), "i8") if anchor is None else anchor.view("i8")
    return pd.DataFrame({"kind": np.full(len(row), kind, "i4"), "piece": np.zeros(len(row), "i4"), "row": row, "value": value.astype("i8"), "anchor": anchor, "pack": np.full(len(row), None, object)})


def _span(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return first << 32 | last


def _runs(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and spans, those of a row that meet or overlap as one."""
    if not len(row):
        return row, first
    order = np.lexsort((first, row))
    row, first, last = row[order], first[order], last[order]
    rank = np.cumsum(np.concatenate([[False], row[1:] != row[:-1]]))
    end = np.maximum.accumulate(rank << 32 | last) & 0xFFFFFFFF
    head = np.flatnonzero(np.concatenate([[True], (rank[1:] != rank[:-1]) | (first[1:] > end[:-1] + 1)]))
    return row[head], _span(first[head], end[np.append(head[1:], len(row)) - 1])


def _by(key: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
    for a, b in zip(cuts, [*cuts[1:], len(key)], strict=True):
        yield key[a].item(), tuple(v[order[a:b]] for v in values)


def _anchored(window: int, pieces: int):
    """Documents' anchors, packed by piece (kind 2), and the ones that a batch itself repeats, by row (kind 1)."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.drop_duplicates("row")
            keys, texts = b.row.to_numpy("i8"), b.text.tolist()
            for rows, ids, row, base in _chunks(texts, keys):
                first, _, at, anchor = segments(ids, row, window)
                if not len(at):
                    continue
                own = keys[rows][row[first]]
                at = at - base[row[first]]
                # the lowest bit says that the anchor is known to be repeated
                key = anchor >> U(1)
                order = np.argsort(key, kind="stable")
                key, own, at = key[order], own[order], at[order]
                head = np.concatenate([[True], key[1:] != key[:-1]])
                again = ~head | np.append(~head[1:], False)
                if again.any():
                    yield _told(own[again], at[again], pieces, key[again])
                met = np.empty(int(head.sum()), MET)
                met["anchor"], met["row"], met["at"] = key[head] << U(1) | again[head].astype("u8"), own[head], at[head]
                found = [(p, m.tobytes()) for p, (m,) in _by((key[head] % U(pieces)).astype("i8"), met)]
                yield _packs([m for _, m in found], [p for p, _ in found])
        release()

    return send


def _repeated():
    """A piece of the anchors: positions of those that occur again, by row."""

    def meet(f: pd.DataFrame) -> pd.DataFrame:
        release()
        told, packs = _heard(f), f["pack"][f.kind == 2]
        # exact copies of a row have one key, and each batch that holds one tells the same
        rest = _facts(told["row"], told["value"], np.ascontiguousarray(told["anchor"])).drop_duplicates(["row", "value"])
        if not len(packs):
            return rest
        met = np.concatenate([np.frombuffer(p, MET) for p in packs])
        met = met[np.argsort(met["anchor"] >> U(1), kind="stable")]
        key, known = met["anchor"] >> U(1), met["anchor"] & U(1)
        head = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.cumsum(head) - 1
        count = np.bincount(group)
        many = (count > 1) | (np.bincount(group, known) > 0)
        new = many[group] & (known == 0)
        hot = key[head][count > HOT]
        found = [rest]
        if new.any():
            found.append(_facts(met["row"][new], met["at"][new], key[new]))
        if len(hot):
            found.append(_facts(np.zeros(len(hot), "i8"), np.zeros(len(hot), "i8"), hot, kind=3))
        return pd.concat(found)

    return meet


def _segmented(window: int, pieces: int):
    """Segments of repeated anchors, packed by piece (kind 2); repeats within the batch at once (kind 1)."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.drop_duplicates("row").sort_values("doc", kind="stable")
            docs, keys, texts, known = b.doc.to_numpy("i8"), b.row.to_numpy("i8"), b.text.tolist(), list(b["at"])
            for rows, ids, row, base in _chunks(texts, docs):
                first, last, at, anchor = segments(ids, row, window)
                own = row[first]
                # of a hot anchor, each window is a segment under a key of its words
                places, hot = (np.concatenate([(known[i] >> 1)[(known[i] & 1) >= k] + base[n] for n, i in enumerate(rows)]) for k in (0, 1))
                first, last, at, anchor, own = _apart(first, last, at, anchor, own, np.isin(at, hot), ids, window)
                use = np.flatnonzero(np.isin(at, places))
                doc, begin = docs[rows][own[use]], base[own[use]]
                order = np.lexsort((at[use] - begin, doc))
                use, doc, begin = use[order], doc[order], begin[order]
                code = np.ascontiguousarray(ids[:, None].view("u1")[:, :CODE])
                seen: dict[bytes, list[tuple]] = {}
                gone = []
                for d, t, k, a, z, o, c in zip(doc.tolist(), (at[use] - begin).tolist(), keys[rows][own[use]].tolist(), first[use].tolist(), last[use].tolist(), begin.tolist(), anchor[use].tolist(), strict=True):
                    w = code[a : z + window].tobytes()
                    same = seen.setdefault(w, [])
                    if same and same[0][1:3] != (d, t):
                        gone.append((k, a - o, z - o))
                    else:
                        same.append((c, d, t, k, a - o, 0 if same else z - a + window))
                if gone:
                    yield _told(*_runs(*np.array(gone, "i8").T), pieces)
                if seen:
                    h = np.array([x for same in seen.values() for x in same], HEAD)
                    words = [w if k == 0 else b"" for w, same in seen.items() for k in range(len(same))]
                    found = [(p, np.int64(len(i)).tobytes() + h[i].tobytes() + b"".join(words[k] for k in i)) for p, (i,) in _by((h["anchor"] % U(pieces)).astype("i8"), np.arange(len(h)))]
                    yield _packs([m for _, m in found], [p for p, _ in found])
        release()

    return send


def _apart(first, last, at, anchor, own, hot, ids, window):
    """Segments of hot anchors cut into their windows, whose words (20 runs of one) make their key."""
    if not hot.any():
        return first, last, at, anchor, own
    n = np.where(hot, last - first + 1, 1)
    of = np.repeat(np.arange(len(n)), n)
    start = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    own_key = runs(ids, window)[start]
    return start, np.where(hot[of], start, last[of]), at[of], np.where(hot[of], own_key, anchor[of]), own[of]


def repeats(found: list[tuple[int, int, int, int, bytes]], window: int) -> list[tuple[int, int, int]]:
    """Of one anchor's segments (doc, at, row, start, words): (row, first, last) window starts whose words start earlier."""
    out, waiting, automaton = [], [], None
    known: set[bytes] = set()
    for _, tied in groupby(sorted(found, key=lambda x: x[:2]), key=lambda x: x[:2]):
        new: dict[bytes, list[tuple[int, int]]] = {}
        for _, _, row, start, words in tied:
            if words in known:
                out.append((row, start, start + len(words) // CODE - window))
                continue
            if words not in new:
                hits = new[words] = []
                if known:
                    automaton = automaton or SuffixAutomaton()
                    for items in waiting:
                        automaton.add(items)
                    waiting = []
                    for i, m in enumerate(automaton.statistics(_items(words))):
                        if m >= window:
                            i -= window - 1
                            if hits and hits[-1][1] == i - 1:
                                hits[-1] = (hits[-1][0], i)
                            else:
                                hits.append((i, i))
            out += [(row, start + a, start + z) for a, z in new[words]]
        known.update(new)
        waiting += [_items(words) for words in new]
    return out


def _items(words: bytes) -> list[bytes]:
    return [words[i : i + CODE] for i in range(0, len(words), CODE)]


def _matched(window: int):
    """A shard: all segments of its anchors; repeated windows by row."""

    def match(f: pd.DataFrame) -> pd.DataFrame:
        release()
        told, packs = _heard(f), f["pack"][f.kind == 2]
        by: dict[int, list[tuple[int, int, int, int, bytes]]] = {}
        for p in packs:
            n = int(np.frombuffer(p[:8], "<i8")[0])
            at = 8 + n * HEAD.itemsize
            for anchor, doc, place, row, start, words in np.frombuffer(p[8:at], HEAD).tolist():
                if words:
                    segment = p[at : at + words * CODE]
                by.setdefault(anchor, []).append((doc, place, row, start, segment))
                at += words * CODE
        gone = [x for found in by.values() if len(found) > 1 for x in repeats(found, window)]
        known = np.column_stack([told["row"], told["value"] >> 32, told["value"] & 0xFFFFFFFF])
        return _facts(*_runs(*np.concatenate([known, np.array(gone, "i8").reshape(-1, 3)]).T))

    return match


def removed(spans: np.ndarray | None, n: int, window: int) -> np.ndarray:
    """Which of a document's n words are covered by its repeated windows."""
    change = np.zeros(n + window + 1, "i8")
    if spans is not None and len(spans):
        first, end = spans >> 32, (spans & 0xFFFFFFFF) + window
        inside = end <= n
        np.add.at(change, first[inside], 1)
        np.add.at(change, end[inside], -1)
    return np.cumsum(change)[:n] > 0


def row_key(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"], docs["text"])


def spans(spark: SparkSession, docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """row (row_key()) and gone: first << 32 | last of each run of repeated windows, by their starts."""
    scratch = Scratch(spark, "substrings")
    texts = parallel(spark, docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), row_key(docs).alias("row"), "text"))
    n = pieces(spark, docs, PIECE)
    anchors = texts.select("row", "text").mapInPandas(_anchored(window, n), SENT).groupBy("piece").applyInPandas(_repeated(), SENT)
    anchors = scratch.write(anchors.select("kind", "row", "value", "anchor"), "anchors")
    hot = bounded(scratch.write(anchors.filter("kind = 3").select("anchor", F.lit(1).alias("hot")), "hot"))
    places = anchors.filter("kind = 1").join(hot, "anchor", "left").select("row", (F.col("value") * 2 + F.coalesce("hot", F.lit(0))).alias("value"))
    places = places.groupBy("row").agg(F.collect_set("value").alias("at"))
    cut = texts.join(places.hint("shuffle_merge"), "row").mapInPandas(_segmented(window, n), SENT).groupBy("piece").applyInPandas(_matched(window), SENT)
    gone = scratch.write(cut.select("row", "value"), "repeats")
    return gone.groupBy("row").agg(F.collect_list("value").alias("gone"))


def _joined(spark: SparkSession, docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """docs with each row's spans, and the name of that column."""
    key, name = free("row_key", docs), free("row_spans", docs)
    found = spans(spark, docs, window=window).withColumnsRenamed({"row": key, "gone": name})
    return docs.join(found, row_key(docs) == F.col(key), "left").drop(key), name


def _spans(part, name: str) -> list[np.ndarray | None]:
    return [None if x is None else np.array(x, "i8") for x in part.column(name).to_pylist()]


def digest(spark: SparkSession, docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""

    def summed(part) -> dict:
        out = {"n_words": [], "n_removed": [], "kept_sha256": []}
        for text, gone in zip(part.column("text").to_pylist(), _spans(part, name), strict=True):
            words = byte_words(text)
            mask = removed(gone, len(words), window)
            kept = [w for w, x in zip(words, mask.tolist(), strict=True) if not x] if mask.any() else words
            for values, x in zip(out.values(), (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()), strict=True):
                values.append(x)
        return out

    joined, name = _joined(spark, docs.select("doc_id", "text"), window)
    return map_rows(joined, summed, "n_words long, n_removed long, kept_sha256 string", drop=("text", name))


TOKEN = re.compile(rb"[ \t-\r]*[^ \t-\r]+")


def cut_text(text: str | None, gone: np.ndarray | None, window: int) -> str | None:
    """The text without its repeated words, each kept word with the white space before it."""
    if text is None or gone is None:
        return text
    parts = TOKEN.findall(text.encode("utf-8", "surrogatepass"))
    mask = removed(gone, len(parts), window)
    return b"".join(p for p, x in zip(parts, mask.tolist(), strict=True) if not x).decode("utf-8", "surrogatepass").lstrip(" \t\n\x0b\x0c\r")


def apply(spark: SparkSession, docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """docs with the repeated spans cut out of text; n_chars, where there is one, follows."""

    joined, name = _joined(spark, docs, window)

    def cut(part) -> dict:
        return {"text": [cut_text(t, g, window) for t, g in zip(part.column("text").to_pylist(), _spans(part, name), strict=True)]}

    return _counted(map_rows(joined, cut, "text string", drop=("text", name)), docs)


def _counted(out: DataFrame, docs: DataFrame) -> DataFrame:
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


REFERENCE_WORDS, SHARD_WORDS = 5_000_000, 50_000


def against(spark: SparkSession, docs: DataFrame, reference: DataFrame, *, window: int = WINDOW, most: int = REFERENCE_WORDS) -> DataFrame:
    """docs without spans of ``window`` words or more that occur in the texts of a reference, wherever they stand.

    The reference is broadcast and must not have more than ``most`` words, or ValueError: a larger one belongs to the
    corpus, as apply() takes it. Each worker builds the automata, of about SHARD_WORDS words each, once.
    """
    words = reference.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    if words > most:
        raise ValueError(f"the reference has {words} words, {most} can be broadcast")
    texts = sorted(r.text for r in reference.select("text").filter("text is not null").distinct().collect())
    sent, key = spark.sparkContext.broadcast(texts), uuid.uuid4().hex

    def cut(part) -> dict:
        if key not in _shards:
            _shards.clear()
            _shards[key] = automata(sent.value)
        return {"text": [cut_text(t, matched(byte_words(t), _shards[key], window), window) for t in part.column("text").to_pylist()]}

    return _counted(map_rows(parallel(spark, docs), cut, "text string", drop=("text",)), docs)


_shards: dict[str, list[SuffixAutomaton]] = {}


def automata(texts: list[str]) -> list[SuffixAutomaton]:
    """Suffix automata of a reference, a new one after every SHARD_WORDS words or so."""
    out, n = [], SHARD_WORDS
    for t in texts:
        if n >= SHARD_WORDS:
            out.append(SuffixAutomaton())
            n = 0
        ids = word_ids(byte_words(t)).tolist()
        out[-1].add(ids)
        n += len(ids)
    return out


def matched(words: list[bytes], shards: list[SuffixAutomaton], window: int) -> np.ndarray | None:
    """Spans of window starts whose words some shard holds."""
    ids = word_ids(words).tolist()
    longest = np.max([s.statistics(ids) for s in shards], axis=0) if shards and ids else np.zeros(0, "i8")
    starts = np.flatnonzero(longest >= window) - window + 1
    return _span(starts, starts) if len(starts) else None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(spark, table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - {WINDOW} + 2)) AS k, w FROM d WHERE len(w) >= {WINDOW}),
h AS (SELECT doc_id, k, md5(list_aggregate(w[k:k + {WINDOW - 1}], 'string_agg', ' ')) AS h FROM x),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY h ORDER BY doc_id, k) AS n FROM h) WHERE n > 1),
g AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(k, k + {WINDOW})) AS p FROM r) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(coalesce(list_aggregate(CASE WHEN gone IS NULL THEN w ELSE list_select(w, list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i))) END, 'string_agg', ' '), '')) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""
