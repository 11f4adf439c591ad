"""Text functions: words, sentences, n-grams, metrics, tokens, splitting. Built-in expressions wherever they can say it."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import release

WORD = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
#: Characters of texts whose chunks are held at a time.
HELD = 1 << 20
ZERO_WIDTH = "​"
#: Separators of the splitter, best first (fixed values).
SEPARATORS = ("\n\n", "\n", " ", ".", ",", "​", "，", "、", "．", "。")


def fused(text: Column) -> Column:
    """Lower case without line feeds and zero-width spaces: words join across line ends."""
    return F.lower(without(text, "\n" + ZERO_WIDTH))


def without(text: Column, characters: str) -> Column:
    """translate() to nothing; replace() scans bytes, where translate() looks every character up."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def continuous_length(text: Column) -> Column:
    """Characters without blanks, line feeds, tabs, zero-width spaces and dashes."""
    return F.length(without(text, " \n\t" + ZERO_WIDTH + "-—")).cast("long")


def words(text: Column) -> Column:
    """Words and single punctuation marks of an already fused text."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def sentences(text: Column) -> Column:
    marked = F.regexp_replace(text, r"([.!?]+)\s+", "$1\u0001")
    return F.filter(F.split(marked, "\u0001"), lambda s: F.trim(s) != "")


def ngrams(words: Column, n: int) -> Column:
    """Runs of n words joined by a space; fewer words have none."""
    joined = F.transform(words, lambda x, i: F.concat_ws(" ", x, *(F.get(words, i + k) for k in range(1, n))))
    return F.slice(joined, 1, F.greatest(F.size(words) - n + 1, F.lit(0)))


def token_count(word: Column) -> Column:
    """Tokens of a word under the default tokenizer, which cuts words into pieces of up to four characters."""
    return F.ceil(F.length(word) / 4).cast("long")


def metrics(books: DataFrame, key: str = "barcode", text: str = "text") -> DataFrame:
    """Sixteen metrics per row. Blank text has character counts of 0 and nulls elsewhere; nothing leaves the row."""
    t = F.coalesce(text, F.lit(""))
    blank = ~t.rlike(r"\S")
    d = books.select(key, t.alias("t"), F.when(blank, F.array().cast("array<string>")).otherwise(words(fused(t))).alias("w"), F.when(blank, F.array().cast("array<string>")).otherwise(sentences(fused(t))).alias("s"))
    d = d.select("*", ngrams(F.col("w"), 2).alias("w2"), ngrams(F.col("w"), 3).alias("w3"))

    def counted(name: str, array: str, size: Column) -> list[Column]:
        n = F.nullif(size, F.lit(0)).cast("long")
        unique = F.nullif(F.size(F.array_distinct(array)), F.lit(0)).cast("long")
        return [n.alias(f"{name}_count"), unique.alias(f"{name}_count_unique"), (unique / n * 100).alias(f"{name}_type_token_ratio")]

    length = F.length("t").cast("long")
    tokens = F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + token_count(x))
    return d.select(
        key,
        F.when(F.size("w") > 0, length).otherwise(0).alias("char_count"),
        F.when(F.size("w") > 0, continuous_length(F.col("t"))).otherwise(0).cast("long").alias("char_count_continuous"),
        *counted("word", "w", F.size("w")),
        # how many there are is known without making them, which costs most and is then left out where they only count
        *counted("bigram", "w2", F.greatest(F.size("w") - 1, F.lit(0))),
        *counted("trigram", "w3", F.greatest(F.size("w") - 2, F.lit(0))),
        *counted("sentence", "s", F.size("s")),
        (F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.length(x)) / F.nullif(F.size("s"), F.lit(0))).alias("average_sentence_length"),
        F.when(F.size("w") > 0, F.least(F.lit(100.0), F.size("w") * 1.25 / tokens * 100)).alias("tokenizability"),
    )


def tokens(books: DataFrame, *, target_llm: str = "default", tokenizer: str = "pieces4", counter: Callable[[list[str]], list[int]] | None = None) -> DataFrame:
    """Tokens per book, 0 for blank text. counter: from texts to counts (Arrow), such as vocabulary()'s, in place of the default.

    A tokenizer that looks across line ends counts page by page where books have text_by_page in place of text.
    """
    paged = "text_by_page" in books.columns
    if counter is not None:
        of = F.pandas_udf(lambda s: pd.Series([sum(counter([t for t in x if t])) for x in s] if paged else counter(s.fillna("").tolist())), "long")
        blank = F.array_join("text_by_page", "") if paged else F.coalesce("text", F.lit(""))
        count = F.when(F.trim(F.translate(blank, "\n\t\r", "")) != "", of(F.coalesce("text_by_page", F.array().cast("array<string>")) if paged else F.col("text")))
    else:
        count = F.aggregate(words(F.array_join("text_by_page", "\n") if paged else F.coalesce("text", F.lit(""))), F.lit(0).cast("long"), lambda a, x: a + token_count(x))
    return books.select("barcode", F.lit(target_llm).alias("target_llm"), F.lit(tokenizer).alias("tokenizer"), F.coalesce(count, F.lit(0)).cast("long").alias("count"))


#: Fixed value: how byte-level vocabularies of 50,000 entries cut words.
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str, pattern: str = CUT) -> Callable[[list[str]], list[int]]:
    """A counter by a vocabulary file that every worker can read: ranks (.tiktoken), .json or a SentencePiece .model."""

    def load():
        if path.endswith(".tiktoken"):
            import base64

            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]

    def count(texts: list[str]) -> list[int]:
        if path not in _counters:
            _counters[path] = load()
        return _counters[path](texts)

    return count


_counters: dict[str, Callable[[list[str]], list[int]]] = {}


def grouped(number: Column) -> Column:
    """Digits in groups of three, as captions show them."""
    return F.format_number(number, 0)


def slug(text: str) -> str:
    """Lower-case letters and digits, everything else one hyphen: a file name of any text."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")


def time_slug(at: datetime | None = None) -> str:
    """A moment to the minute, UTC, as a part of file names."""
    return (at or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%d-%H-%M")


def split_text(text: str, size: int) -> list[str]:
    """Pieces of up to size characters: cut at the best separator there is, packed greedily, trimmed, empty ones dropped."""

    def cut(part: str, level: int) -> Iterator[str]:
        if len(part) <= size:
            yield part
            return
        if level == len(SEPARATORS):
            yield from (part[i : i + size] for i in range(0, len(part), size))
            return
        sep = SEPARATORS[level]
        for i, piece in enumerate(part.split(sep)):
            yield from cut(piece if not i else sep + piece, level + 1)

    out, now = [], ""
    for piece in cut(text, 0):
        if now and len(now) + len(piece) > size:
            out.append(now)
            now = ""
        now += piece
    return [s for s in (x.strip() for x in [*out, now]) if s]


def chunks(books: DataFrame, size: int = 768, least: int = 10) -> DataFrame:
    """barcode, chunk_number, chunk. Chunks shorter than ``least`` are left out."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, held = [], 0
            for k, t in zip(b.barcode, b.text, strict=True):
                rows += [(k, i, c) for i, c in enumerate(split_text(t or "", size)) if len(c) >= least]
                held += len(t or "")
                if held >= HELD:
                    yield pd.DataFrame(rows, columns=["barcode", "chunk_number", "chunk"])
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["barcode", "chunk_number", "chunk"])
            release()

    return books.select("barcode", "text").mapInPandas(cut, "barcode string, chunk_number int, chunk string")
