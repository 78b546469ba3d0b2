"""Quality rules, line first.

Every line of a document is judged on its own by three families of rules:

* punctuation: too many symbols for its words, or a short line that ends in no
  sentence mark, or a line whose words carry hardly any letter;
* navigation: menu separators between most words, or "home / next / log in"
  labels and nothing else;
* boilerplate: stock phrases of sites (cookies, terms, script notices), and
  lines that repeat an earlier line of the same document.

Failing lines are removed.  A document that loses more than ``max_lost_share``
of its words is rejected; so is one that fails the whole-text base rules (too
few words, or more than half of its words in repeated three-word windows).

Defined cases: a null text counts as no text (all counts 0, not kept, cleaned
text empty); a text without words likewise; equal rows give equal results;
an empty table gives an empty result; other columns pass through untouched
(results come in one struct column, so names cannot clash).  Memory per row is
proportional to that row's text; nothing is gathered across rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfarer.llm.common import BLANKS, small_batches

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_END = re.compile(r"[.!?…:;。！？][\"'”’»)\]]*$")
_MENU_MARK = re.compile(r"^[|>»›·•/\\<«‹–—-]+$")
_MENU_LABEL = re.compile(
    r"(?:home|menu|next|previous|prev|back|top|search|log ?in|log ?out|sign ?(?:in|up|out)|register|"
    r"contact(?: us)?|about(?: us)?|sitemap|share|print|login|more|read more|click here|skip to content)")
_STOCK = re.compile(
    r"cookie (?:policy|settings)|uses? cookies|privacy policy|terms (?:of|and) (?:use|service|conditions)|"
    r"enable javascript|all rights reserved|lorem ipsum|subscribe to our newsletter|powered by")


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""

    max_symbols_per_word: float = 0.1
    min_unpunctuated_words: int = 5
    min_letter_words_share: float = 0.5
    max_menu_share: float = 0.3
    max_stock_words: int = 20
    drop_repeated_lines: bool = True
    max_lost_share: float = 0.5


def line_fault(line: str, n_words: int, rules: LineRules) -> str | None:
    """The first rule that ``line`` (with at least one word) fails, or None."""
    symbols = sum(line.count(c) for c in SYMBOLS)
    if symbols:
        tokens = line.split()
        marks = sum(1 for w in tokens if _MENU_MARK.match(w))
        if marks > rules.max_menu_share * n_words:
            return "navigation"
        if symbols > rules.max_symbols_per_word * n_words:
            return "punctuation"
    body = line.strip(BLANKS)
    if n_words < rules.min_unpunctuated_words and not _END.search(body):
        return "navigation" if _MENU_LABEL.fullmatch(body.lower()) else "punctuation"
    if n_words <= rules.max_stock_words and _STOCK.search(body.lower()):
        return "boilerplate"
    lettered = sum(1 for w in line.split() if any(map(str.isalpha, w)))
    if lettered < rules.min_letter_words_share * n_words:
        return "punctuation"
    return None


def repeat_words(w: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more (each word once)."""
    windows = list(zip(w, w[1:], w[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, covered = 0, 0  # covered: end of the counted stretch
    for i, x in enumerate(windows):
        if counts[x] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def judge(text: str | None, rules: LineRules, with_text: bool) -> tuple:
    text = text or ""
    n = word_chars = symbols = dup = repeated = lost = removed = 0
    faults = {"punctuation": 0, "navigation": 0, "boilerplate": 0, "repeated": 0}
    kept_lines: list[str] = []
    if text:
        w = text.encode().split()  # bytes split on exactly the six ASCII blanks
        n = len(w)
        word_chars = len(text) - sum(text.count(c) for c in BLANKS)
        symbols = sum(text.count(c) for c in SYMBOLS)
        repeated = repeat_words(w)
        seen: set[str] = set()
        for line in text.split("\n"):
            k = len(line.encode().split())
            if not k:
                kept_lines.append(line)
                continue
            again = line in seen
            dup += again
            seen.add(line)
            fault = line_fault(line, k, rules) or ("repeated" if again and rules.drop_repeated_lines else None)
            if fault:
                faults[fault] += 1
                removed += 1
                lost += k
            else:
                kept_lines.append(line)
    base_failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    kept = not base_failed and lost <= rules.max_lost_share * n
    row = (n, word_chars, symbols, dup, repeated, base_failed, kept, removed, lost, *faults.values())
    return (*row, "\n".join(kept_lines)) if with_text else row


_ROWS = 500
_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIELDS = [(c, "bigint") for c in _LONGS] + [("base_failed", "boolean"), ("kept", "boolean")] + [
    (c, "bigint") for c in ("lines_removed", "words_removed", "punctuation_lines", "navigation_lines",
                            "boilerplate_lines", "repeated_lines")]


def quality(text: Column, rules: LineRules = LineRules(), with_text: bool = False) -> Column:
    """Struct of counts and verdict for a text column; ``with_text`` adds ``cleaned``."""
    fields = _FIELDS + ([("cleaned", "string")] if with_text else [])
    schema = T.StructType([T.StructField(n, T.LongType() if t == "bigint" else T.BooleanType() if t == "boolean"
                                         else T.StringType()) for n, t in fields])
    names = [n for n, _ in fields]

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            for i in range(0, len(s), _ROWS):  # small frames: a batch's cleaned texts need not exist at once
                yield pd.DataFrame([judge(t, rules, with_text) for t in s.iloc[i:i + _ROWS]], columns=names)

    return run(text)


def clean_documents(docs: DataFrame, text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents with failing lines removed from their text, same columns."""
    small_batches(docs.sparkSession)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    judged = packed.withColumn("q", quality(F.col(f"doc.`{text_col}`"), rules, with_text=True)).where("q.kept")
    return judged.select(*[
        (F.col("q.cleaned") if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: id, counts and verdict (no text)."""
    small_batches(docs.sparkSession)
    q = docs.select(F.col(id_col).alias("doc_id"), quality(F.col(text_col), rules).alias("q"))
    return q.select("doc_id", "q.*")
