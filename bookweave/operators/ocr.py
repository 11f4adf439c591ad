"""Scanned text, line by line: classification features, readable recomposition, book-level clean-up.

Recomposition is a fold: a line's treatment depends on what the line before it has become, so pages are folded in an
Arrow function, each page by itself; what needs the whole book follows per book.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import LINE_TYPES

#: Fixed values.
DASHES = "-‐‑‒–—―−⸺⸻﹘﹣－"
STOPS = ".!;:?"
BREAK, RULE = "\n\n", "\n\n---\n\n"
#: Joins of breaks inside sentences, then literal replacements for a number of rounds, in this order.
JOINS = ((r"([a-z])\n\n([a-z])", r"\1 \2"), (r"([a-z] +)\n\n([a-z])", r"\1 \2"), (r"(,+)\n\n([a-zA-Z0-9])", r"\1 \2"), (r"(, +)\n\n([a-zA-Z0-9])", r"\1 \2"))
ROUNDS = 5
REPLACEMENTS = (("\n\n\n", BREAK), ("\n \n", BREAK), ("\n\n ", BREAK), ("-\n\n", " "), ("\n\n--\n", RULE), ("\n\n- - \n", RULE), ("\n\n- -\n", RULE), ("\n\n-- ", BREAK), ("---\n\n---\n\n", "---\n\n"), ("  ", " "))
PAGE_NUMBER = r"^[^a-zA-Z0-9]*[+-]?(\d+(\.\d+)?|\.\d+)[^a-zA-Z0-9]*$"
FIRST_HEAD_PAGE = 10
PROCESSED_LANGUAGES = ("eng", "deu", "fra", "ita", "spa")


def lines(books: DataFrame) -> DataFrame:
    """barcode, page_number, total_pages, line_number, total_lines, text; numbers from 1. books: barcode, text_by_page."""
    d = books.select("barcode", F.size("text_by_page").alias("total_pages"), F.posexplode("text_by_page").alias("p", "page"))
    d = d.select("barcode", (F.col("p") + 1).alias("page_number"), "total_pages", F.split("page", "\n").alias("l"))
    return d.select("barcode", "page_number", "total_pages", F.size("l").alias("total_lines"), F.posexplode("l").alias("n", "text")).select("barcode", "page_number", "total_pages", (F.col("n") + 1).alias("line_number"), "total_lines", "text")


def representation() -> Column:
    """What a line classifier reads."""
    return F.concat(F.lit("<<"), "page_number", F.lit("-"), "total_pages", F.lit(","), "line_number", F.lit("-"), "total_lines", F.lit(">> "), "text")


def prelabel() -> Column:
    """Types that rules can tell; null for the rest."""
    noise = (F.trim("text") == "") | F.col("text").rlike(r"^[^a-zA-Z0-9\s]$")
    return F.when(noise, "NOISE_OR_BROKEN_TEXT").when((F.col("line_number") < 4) & F.col("text").rlike(PAGE_NUMBER), "PAGE_NUMBER")


def classified(rows: DataFrame, classifier: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """rows with target_type: a classifier's answer for the representation, or else rules and simple shape heuristics."""
    if classifier is not None:
        return rows.withColumn("target_type", F.pandas_udf(classifier, "string")(representation()))
    order = Window.partitionBy("barcode", "page_number").orderBy("line_number")
    short = F.size(F.split("text", " ")) <= 6
    guess = (
        F.when(F.col("text").rlike(r"^[-–—*_=~]{2,}$"), "SEPARATOR")
        .when((F.col("line_number") == 1) & (F.col("page_number") >= FIRST_HEAD_PAGE) & short, "RUNNING_HEAD")
        .when(short & (F.upper("text") == F.col("text")) & F.col("text").rlike(r"\p{L}"), "HEADING_OR_TITLE")
        .when(F.col("text").rlike(r"[.!?]\s*$") & F.coalesce(F.lead("text").over(order).rlike(r"^\p{Lu}"), F.lit(True)), "PARAGRAPH_END")
        .otherwise("PARAGRAPH_CHUNK")
    )
    return rows.withColumn("target_type", F.coalesce(prelabel(), guess))


def sample(books: DataFrame, languages: DataFrame, words: DataFrame, is_pd: DataFrame, *, n: int, among: tuple[str, ...] = ("eng",), least: int = 1000, seed: int = 0) -> DataFrame:
    """A seeded random sample of n open-access books of some languages with more than ``least`` words: barcode, page_number, set.

    books: barcode, count_from_ocr. One random page each; 90 % of the books train, 10 % test, both rounded half to even,
    and what rounding leaves over trains. The order is a hash of seed and barcode, the same on every cluster.
    """
    if n < 10:
        raise ValueError("a training set takes ten books or more")
    test = round(10 * n / 100)
    train = max(round(90 * n / 100), n - test)
    hashed = lambda salt: F.md5(F.concat(F.lit(f"{seed}{salt}"), "barcode"))
    d = books.filter("count_from_ocr > 0").join(languages.filter(F.col("from_detection_iso639_3").isin(*among)).select("barcode"), "barcode", "left_semi")
    d = d.join(words.filter(F.col("word_count") > least).select("barcode"), "barcode", "left_semi").join(is_pd.filter("is_pd").select("barcode"), "barcode", "left_semi")
    d = d.select("barcode", "count_from_ocr", hashed("book").alias("_k")).orderBy("_k", "barcode").limit(n)
    turn = F.row_number().over(Window.orderBy("_k", "barcode"))  # of n rows
    return d.withColumn("_t", turn).select("barcode", (F.conv(F.substring(hashed("page"), 1, 8), 16, 10).cast("long") % F.col("count_from_ocr") + 1).cast("int").alias("page_number"), F.when(F.col("_t") <= train, "train").otherwise("test").alias("set"))


def prompt_options() -> Column:
    """Types that a language model may choose from, by a line's place on its page and in the book."""
    total, page, line = F.col("total_pages"), F.col("page_number"), F.col("line_number")
    no_head = (page < 5) | (page > F.rint(F.floor(total / 20) * 19)) | (line > 5)
    no_number = (line > 5) & (line < F.rint(F.floor(F.col("total_lines") / 4) * 3))
    return F.filter(F.array(*map(F.lit, LINE_TYPES)), lambda t: ~((t == "RUNNING_HEAD") & no_head) & ~((t == "PAGE_NUMBER") & no_number))


def annotation_context(rows: DataFrame) -> DataFrame:
    """Each line with its neighbours; the second line of a page has no previous one, as the annotation tool shows it."""
    order = Window.partitionBy("barcode", "page_number").orderBy("line_number")
    return rows.withColumn("previous", F.when(F.col("line_number") > 2, F.lag("text").over(order))).withColumn("next", F.lead("text").over(order))


def annotation_markup(language: str = "language") -> Column:
    """What a language model reads of a line of annotation_context(): its place (one more than the numbers, as stored answers have it), the line and its neighbours."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    place = F.concat(F.lit("Page "), F.col("page_number") + 1, F.lit(" of "), "total_pages", F.lit(", Line "), F.col("line_number") + 1, F.lit(" of "), "total_lines", F.lit(", Language: "), F.coalesce(language, F.lit("None")))
    near = lambda name, end: F.coalesce(F.concat(tag(name, F.col(name)), F.lit(end)), F.lit(""))
    return F.concat(tag("context", place), F.lit("\n"), near("previous", "\n"), tag("current", F.col("text")), F.lit("\n"), near("next", ""))


#: How a language model is asked; {types} are those of prompt_options().
INSTRUCTIONS = (
    "You classify lines of text that were scanned from books. <context> says where the line stands and the book's language, <current> is the line, "
    "<previous> and <next> are its neighbours, if any. Answer with the one type that fits <current> best, and nothing else.\n\nTypes:\n{types}"
)


def annotation_prompt() -> Column:
    head, tail = INSTRUCTIONS.split("{types}")
    return F.concat(F.lit(head), F.concat_ws("\n", F.transform(prompt_options(), lambda t: F.concat(F.lit("- "), t))), F.lit(tail))


def reply_type(reply: Column) -> Column:
    """The type that a model's reply names: its first word of capitals; null where that is no type."""
    said = F.regexp_extract(reply, r"\b[A-Z](?:_?[A-Z])*_?\b", 0)
    return F.when(said.isin(*LINE_TYPES), said)


def labelled(rows: DataFrame, answer: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Lines of annotation_context() with target_type: rules where they can tell, else a model's answer.

    answer: an Arrow function from (prompt, markup) to replies. Replies that name no type leave the line without one.
    """
    asked = F.pandas_udf(answer, "string")(F.struct(annotation_prompt().alias("prompt"), annotation_markup().alias("markup")))
    return rows.withColumn("target_type", F.coalesce(prelabel(), reply_type(asked)))


class _Line:
    __slots__ = ("text", "kind")

    def __init__(self, text: str, kind: str):
        self.text, self.kind = text, kind

    def upright(self) -> bool:
        return bool(self.text) and (self.text[0].isdigit() or self.text[0].isupper())

    def dehyphenate(self, after: _Line | None) -> str:
        """Cut a dash that the next line continues in lower case. What follows the line: nothing, or else a space."""
        if self.text and self.text[-1] in DASHES and after and after.text and after.text[0].islower():
            self.text = self.text[:-1]
            return ""
        return " "

    def break_after_last_stop(self) -> None:
        at = max((self.text.rfind(s) for s in STOPS), default=-1)
        if at >= 0 and len(self.text.strip().split(" ")) > 1:
            self.text = self.text[: at + 1] + BREAK + self.text[at + 1 :]


def _noise(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    t = line.text
    dash = t[0] in DASHES and t[1:] in ("", "\n")
    if dash or len(t) > 1 and len(set(t)) == 1 and not re.match(r"[\w\s]", t):
        return RULE
    if len(t) == 1:
        return ""
    return line.text + " " if len(t.split(" ")) <= 2 else (lambda end: line.text + end)(line.dehyphenate(after))


def _head(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    if n <= 10 and page >= FIRST_HEAD_PAGE:
        return ""
    return _plain(line, before, after, page, n)


def _plain(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    line.kind = "UNKNOWN"
    return line.text + " "


def _heading(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    end = line.dehyphenate(after)
    first, last = (not other or other.kind != line.kind for other in (before, after))
    line.text = BREAK * first + line.text + end + BREAK * last
    if line.text[-2:-1] and line.text[-2] in STOPS:
        line.text += BREAK
    return line.text


def _chunk(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    end = line.dehyphenate(after)
    if not any(other and other.kind in ("PARAGRAPH_CHUNK", "LOOSE_SENTENCE_OR_LIST_ITEM") for other in (before, after)):
        line.break_after_last_stop()
    if before and any(s in before.text for s in STOPS) and line.upright():
        line.text = BREAK + line.text
    return line.text + end


def _end(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    line.break_after_last_stop()
    return line.text + BREAK


def _item(line: _Line, before: _Line | None, after: _Line | None, page: int, n: int) -> str:
    end = line.dehyphenate(after)
    if line.upright() and len(line.text.split(" ")) > 1:
        line.text = BREAK + line.text
    if end and after and after.text and after.kind != line.kind and after.text[0].isupper():
        line.text += BREAK
    return line.text + end


_TREAT = {"NOISE_OR_BROKEN_TEXT": _noise, "RUNNING_HEAD": _head, "HEADING_OR_TITLE": _heading, "PARAGRAPH_CHUNK": _chunk, "PARAGRAPH_END": _end, "LOOSE_SENTENCE_OR_LIST_ITEM": _item, "SEPARATOR": lambda *_: RULE}


def cleaned(text: str) -> str:
    text = text.strip()
    for pattern, to in JOINS:
        text = re.sub(pattern, to, text)
    for _ in range(ROUNDS):
        for a, b in REPLACEMENTS:
            text = text.replace(a, b)
    return text.strip()


def recompose(page: int, texts: list[str], kinds: list[str]) -> tuple[str, list[str]]:
    """A page's text, and its lines' types after re-typing. Page numbers are kept and become UNKNOWN; so do kept heads."""
    own = [_Line(t or "", k) for t, k in zip(texts, kinds, strict=True)]
    out = []
    for i, line in enumerate(own):
        if line.text.strip():
            treat = _TREAT.get(line.kind, _plain)
            out.append(treat(line, own[i - 1] if i else None, own[i + 1] if i + 1 < len(own) else None, page, i + 1))
    return cleaned("".join(out)), [x.kind for x in own]


def running_heads(pages: list[str]) -> list[str]:
    """Blocks of three words or more that stand among the first six of more than three pages; longest first."""
    count = Counter(b for p in pages for b in map(str.strip, p.split(BREAK)[:6]) if len(b.split(" ")) >= 3)
    return sorted((b for b, n in count.items() if n > 3), key=lambda b: (-len(b), b))


def without_heads(pages: list[str]) -> list[str]:
    heads, out = running_heads(pages), []
    for i, p in enumerate(pages):
        if i >= FIRST_HEAD_PAGE:
            for h in heads:
                p = p.replace(h, "", 1)
            for _ in range(3):
                p = p.replace("\n\n \n\n", BREAK).replace("\n\n\n", BREAK)
            p = p.strip()
        out.append(p)
    return out


#: Digits that a line end cut, and leading page numbers, tried in this order on the first ten characters.
HYPHENATED_DIGITS = r"(?<![-\w])(\d+)[\-–—‒―]\s+(\w+)"
LEADING_NUMBERS = (r"[−–—-]\s*\d+\s*[−–—-]", r"[−–—-]\s*\d+", r"[0-9]+ ")


def without_page_number(text: str) -> str:
    for pattern in LEADING_NUMBERS:
        if re.search(pattern, text[:10]):
            return re.sub(pattern, "", text, count=1).strip()
    return text.strip()


def finish(pages: list[str]) -> list[str]:
    """Book-level clean-up of its pages, in order."""
    pages = [re.sub(HYPHENATED_DIGITS, r"\1\2", p) for p in without_heads(pages)]
    return [without_page_number(p) if i >= FIRST_HEAD_PAGE else p for i, p in enumerate(pages)]


def postprocess(rows: DataFrame) -> DataFrame:
    """barcode, text_by_page, stats (lines by type). rows: classified lines, of which a book's are gathered by arrays.

    A page is at most some hundred lines and a book some thousand pages; both are bounded by the book itself.
    """
    pages = rows.groupBy("barcode", "page_number").agg(F.array_sort(F.collect_list(F.struct("line_number", "text", "target_type"))).alias("l"))
    books = pages.groupBy("barcode").agg(F.array_sort(F.collect_list(F.struct("page_number", F.col("l.text").alias("texts"), F.col("l.target_type").alias("kinds")))).alias("p"))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [[recompose(p["page_number"], list(p["texts"]), list(p["kinds"])) for p in book] for book in b.p]
            yield pd.DataFrame({"barcode": b.barcode, "text_by_page": [finish([t for t, _ in d]) for d in done], "stats": [dict(Counter(k for _, kinds in d for k in kinds)) for d in done]})

    return books.mapInPandas(fold, "barcode string, text_by_page array<string>, stats map<string,int>")


def train_classifier(rows: DataFrame, features: int = 1 << 16):
    """An MLlib pipeline from line representation to type; rows: labelled lines. Rows of the test set are left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, IndexToString, RegexTokenizer, StringIndexer

    own = rows.filter("target_type is not null and coalesce(set, 'train') = 'train'").select(representation().alias("chunk"), "target_type")
    index = StringIndexer(inputCol="target_type", outputCol="label").fit(own)
    stages = [RegexTokenizer(inputCol="chunk", outputCol="words", pattern=r"\s+"), HashingTF(inputCol="words", outputCol="features", numFeatures=features), LogisticRegression(maxIter=20), IndexToString(inputCol="prediction", outputCol="predicted_type", labels=index.labels)]
    fitted = Pipeline(stages=stages).fit(index.transform(own))
    return fitted


def classified_by(model, rows: DataFrame) -> DataFrame:
    """rows with target_type by a model of train_classifier()."""
    d = model.transform(rows.withColumn("chunk", representation()))
    return d.drop("chunk", "words", "features", "rawPrediction", "probability", "prediction", "target_type").withColumnRenamed("predicted_type", "target_type")


def evaluation(model, rows: DataFrame) -> DataFrame:
    """Per type of the test set: precision, recall, f1 and support, from one table of counts by (type, answer)."""
    test = rows.filter("set = 'test' and target_type is not null").withColumnRenamed("target_type", "wanted")
    counts = classified_by(model, test.withColumn("target_type", F.lit(None).cast("string"))).groupBy("wanted", F.col("target_type").alias("said")).agg(F.count("*").alias("n"))
    hit = F.sum(F.when(F.col("wanted") == F.col("said"), F.col("n")).otherwise(0))
    want = counts.groupBy(F.col("wanted").alias("target_type")).agg(F.sum("n").alias("support"), hit.alias("hit"))
    gave = counts.groupBy(F.col("said").alias("target_type")).agg(F.sum("n").alias("given"))
    d = want.join(gave, "target_type", "left").withColumn("precision", F.coalesce(F.col("hit") / F.col("given"), F.lit(0.0))).withColumn("recall", F.col("hit") / F.col("support"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return d.select("target_type", "precision", "recall", f1.alias("f1"), "support")
