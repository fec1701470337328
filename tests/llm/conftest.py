import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts or (doc_id, text[, source]) rows, with columns whose names clash."""

    def make(rows, clashing=True):
        full = []
        for n, r in enumerate(rows):
            doc_id, text, source = (n, r, f"src{n % 3}") if r is None or isinstance(r, str) else (*r, None)[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text)))
        df = spark.createDataFrame(full, SCHEMA)
        if clashing:
            from pyspark.sql import functions as F

            for name in ("_row", "key", "fp", "mark", "places", "lines", "counted", "cuts", "n", "size", "bin", "starts", "block"):
                df = df.withColumn(name, F.lit(7))
        return df

    return make


def prose(seed: int, words: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows: plain, copies, near copies, shared passages, odd texts, ties and repeated rows."""
    rng = random.Random(5)
    rows = []
    shared = " ".join(prose(99, 40))
    for n in range(60):
        words = prose(n, rng.randrange(5, 160))
        lines = [" ".join(words[k : k + 9]) + "." for k in range(0, len(words), 9)]
        rows.append((n, "\n".join(lines)))
    for n in range(60, 75):
        rows.append((n, rows[n % 7][1]))
    for n in range(75, 95):
        words = rows[10 + n % 5][1].split(" ")
        words[rng.randrange(len(words))] = f"new{n}"
        rows.append((n, " ".join(words)))
    for n in range(95, 110):
        rows.append((n, " ".join(prose(n, 20)) + "\n" + shared + "\n" + " ".join(prose(n + 500, 20))))
    odd = [
        None, "", " ", "\n\n", "one", "two words", "a b c", "A B C", "a b c d", "É è   x y \x1c z \x85 q", "İstanbul ǅ ß ﬁ Σας",
        "a  b\t\tc \n d\r\n e", "日本語 の テキスト 🙂🙂", "x" * 5000, "don't we'll I'm they've it's", "1234 5 67,89 !!??", "<|endoftext|> and <|startoftext|>",
        "é café", "a b c d e f g h i j k l m\n" * 3, "same line here\n" * 8, " ".join(["long", "text"] * 4000),
    ]
    rows += [(200 + n, t) for n, t in enumerate(odd)]
    rows += [(200, None), (5, rows[5][1]), (5, "another text with the same id, and some more words to fill it up to a window or two"), (None, "no id here"), (None, rows[3][1]), (None, None)]
    return rows
