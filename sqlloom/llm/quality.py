"""Quality rules, lines first: failing lines go, then documents that lose too much of their text.

A line with a word fails by one of three rules:

* punctuation: fewer than ``SHORT_LINE`` words and no closing mark at its end, or at least half of
  its words end in a run of two or more marks;
* navigation: one in five of its words or more is a separator and nothing else;
* boilerplate: at most ``BOILERPLATE_WORDS`` words and one of the phrases of site furniture.

The document is then rejected if the failing lines hold more than ``MOST_LOST`` of its words.
Lines without a word never fail.  Document counts for the base rules are taken on the whole text.

Defined cases: a null text counts as empty, has no words and fails the base rules; repeated rows are
judged alike; an empty table gives no rows; other columns are not read by ``judged`` and
are kept by ``clean``.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT_LINE = 5
BOILERPLATE_WORDS = 20
MOST_LOST = 0.5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
# Fixed values.
SYMBOLS = "#*$%&|<>"
CLOSING = (".", "!", "?", ":", ";", '"', "'", ")", "]", "…", "”", "’", "»", "。", "！", "？")
MARKED_WORD = r"[!?#*$%&<>|]{2,}$"
SEPARATOR_WORD = r"^[|/\\>»›•·-]+$"
PHRASES = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "lorem ipsum", "privacy policy",
    "read more", "share this", "sign in", "sign up", "subscribe to", "terms of service", "terms of use",
)
BLANK = "[\x20\x09-\x0d]"

_marked = re.compile(MARKED_WORD).search
_separator = re.compile(SEPARATOR_WORD).search
_phrase = re.compile("|".join(map(re.escape, PHRASES))).search
_words = re.compile(r"[^\x20\x09-\x0D]+").findall
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_fails(line: str, words: list[str]) -> bool:
    """Whether a line with these words fails; a line without words never does."""
    n = len(words)
    if not n:
        return False
    if n < SHORT_LINE and not words[-1].endswith(CLOSING):
        return True
    if 2 * sum(1 for w in words if _marked(w)) >= n:
        return True
    if 5 * sum(1 for w in words if not w[0].isalnum() and _separator(w)) >= n:
        return True
    return n <= BOILERPLATE_WORDS and _phrase(line.lower()) is not None


def repeated_words(words: list) -> int:
    """Words covered by windows of five words that occur twice or more."""
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    windows = [*zip(*[words[k:] for k in range(REPEAT_WINDOW)])]
    if len(set(windows)) == n:
        return 0
    counts, covered, upto = Counter(windows), 0, 0
    for at, w in enumerate(windows):
        if counts[w] > 1:
            covered += at + REPEAT_WINDOW - max(at, upto)
            upto = at + REPEAT_WINDOW
    return covered


def judge(text: str) -> tuple:
    """(the counts, words in failing lines, kept lines) of one text."""
    seen, dup, lost, words, kept = set(), 0, 0, [], []
    for line in text.split("\n"):
        own = _words(line)
        if own:
            dup += line in seen
            seen.add(line)
            words += own
        if line_fails(line, own):
            lost += len(own)
        else:
            kept.append(line)
    chars = sum(map(len, words))
    symbols = sum(text.count(s) for s in SYMBOLS)
    return len(words), chars, symbols, dup, repeated_words(words), lost, kept


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts, lost_words, base_failed, kept) for every row."""

    def task(batches):
        for batch in batches:
            rows = [judge(t)[:6] for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names)

    names = ["doc_id", *COUNTS, "lost_words"]
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit(""))).mapInArrow(
        task, ", ".join(f"{n} bigint" for n in names)
    )
    return with_verdict(found)


def with_verdict(found: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    return found.withColumn("kept", ~failed & (F.col("lost_words") <= MOST_LOST * F.col("n_words")))


def clean(docs: DataFrame) -> DataFrame:
    """Kept rows of docs, all columns, their texts without the failing lines."""
    schema = docs.schema
    at = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            keep, texts = [], []
            for t in batch.column(at).to_pylist():
                n, _, _, _, repeated, lost, kept = judge(t or "")
                keep.append(n >= LEAST_WORDS and 100 * repeated <= MOST_REPEATED_PERCENT * n and lost <= MOST_LOST * n)
                texts.append("\n".join(kept))
            changed = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield changed.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(task, schema)
