"""Spelling variants: a delimited vocabulary in bidirectional FM-indexes, searched with one error.

Two words one edit apart share the left or the right half of either one.  Rows are therefore dealt by half: a word comes to its
own halves as a question and to the halves of the neighbouring lengths as part of the index.  A task
takes whole groups up to ``WORDS_AT_ONCE`` words, builds the index of the text ``$one$two$...$``
and its reverse, matches the half exactly with the delimiter outside and extends across the other half, one
error allowed, until the other delimiter.  Both suffix-rank intervals move together, so the forward one
ends at the rank of the word found.  Groups above the limit are split by the word's hash, and
their questions go to every piece.

Links from a word to its most frequent near word, if that occurs ``RATIO`` times as often, lead to a root; links go
up in frequency, so following them doubles the distance in each written round and ends.

Defined cases: null and empty texts have no words; repeated rows count one by one; a null doc_id hashes as the empty
text; of near words with equal counts the smallest in code-point order is the form; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlloom.llm.common import saved, text_bytes

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
DELETE_ONE_IN = 199
WORDS_AT_ONCE = 1 << 16
COUNTED_AT_ONCE = 1 << 17
BLOCK = 32
QUESTIONS_AT_ONCE = 1 << 14


def words_of(doc_id, text: bytes, least: int = LEAST_LENGTH, one_in: int = DELETE_ONE_IN) -> Counter:
    """UTF-8 words of a text with their numbers: runs of Latin letters in lower case, some with a letter deleted."""
    plain = rb"[a-z]{%d,}" if text.isascii() else rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}"
    start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    start = zlib.crc32(b":", start)
    found = Counter(re.findall(plain % least, text.lower()))
    # All runs that lose a letter leave first: what is made of them is not changed again.
    changed = [(w, h, found.pop(w)) for w, h in [(w, zlib.crc32(w, start)) for w in found] if not h % one_in]
    for word, h, n in changed:
        letters = word.decode()
        if len(letters) > least:
            at = h % len(letters)
            found[(letters[:at] + letters[at + 1 :]).encode()] += n
    return found


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, one_in: int = DELETE_ONE_IN) -> DataFrame:
    """(word, n): the words of at least ``least`` letters that occur ``count`` times."""

    def task(batches):
        held: Counter = Counter()

        def sent():
            words, numbers = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(words_of(doc_id, text, least, one_in))
                if len(held) >= COUNTED_AT_ONCE:
                    yield sent()
        yield sent()

    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text")).mapInArrow(task, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


class WordIndex:
    """Bidirectional FM-index of sorted, different words, with ranks sampled every ``BLOCK`` letters.

    Letter 0 ends the text, letter 1 delimits words; a suffix that starts at the delimiter before word k has rank ``first + k``.
    """

    def __init__(self, words: list[str]):
        self.letters = sorted(set("".join(words)))
        self.code = {c: n + 2 for n, c in enumerate(self.letters)}
        self.sigma = len(self.letters) + 2
        joined = np.array([self.code[c] for c in "".join(words)], np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.ones(len(joined) + len(words) + 1, np.int64)
        text[np.arange(len(joined)) + np.repeat(np.arange(len(words)), lengths) + 1] = joined
        self.forward = _Ranks(np.append(text, 0), self.sigma)
        self.backward = _Ranks(np.append(text[::-1], 0), self.sigma)
        self.n = len(text) + 1
        # Suffixes by first letter, one array for both directions; the last delimiter has no word after it.
        self.before = np.concatenate(([0], np.cumsum(np.bincount(np.append(text, 0), minlength=self.sigma))))
        self.first = int(self.before[1]) + 1

    def whole(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of the empty text, n times: (forward start, backward start, size)."""
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n, np.int64)

    def extend(self, states, letter: np.ndarray, left: bool):
        """Each interval with one more letter on its left or right side."""
        own, other, size = states if left else (states[1], states[0], states[2])
        ranks = self.forward if left else self.backward
        low, below_low = ranks.before(own, letter)
        high, below_high = ranks.before(own + size, letter)
        own, other, size = self.before[letter] + low, other + below_high - below_low, high - low
        return (own, other, size) if left else (other, own, size)

    def branches(self, states, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(state number, letter): every letter, delimiters aside, that may stand next to each interval."""
        own, size = (states[0] if left else states[1]), states[2]
        ranks = self.forward if left else self.backward
        few = size <= self.sigma
        who = np.repeat(np.flatnonzero(few), size[few])
        at = np.arange(len(who)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        pairs = np.unique(who * self.sigma + ranks.bwt[own[who] + at])
        many = np.flatnonzero(~few)
        pairs = np.concatenate((pairs, (many[:, None] * self.sigma + np.arange(2, self.sigma)).ravel()))
        who, letter = pairs // self.sigma, pairs % self.sigma
        return who[letter > 1], letter[letter > 1]


class _Ranks:
    """The letters before all sorted suffixes, with numbers of smaller letters at every ``BLOCK``-th."""

    def __init__(self, text: np.ndarray, sigma: int):
        n = len(text)
        self.bwt = text[_sorted_suffixes(text) - 1].astype(np.int16)
        blocks = n // BLOCK + 1
        counts = np.bincount(np.arange(n) // BLOCK * sigma + self.bwt, minlength=blocks * sigma).reshape(blocks, sigma)
        counts = np.cumsum(counts, axis=0) - counts
        self.smaller = np.concatenate((np.zeros((blocks, 1), np.int64), np.cumsum(counts, axis=1)), axis=1).astype(np.int32)
        self.padded = np.concatenate((self.bwt, np.full(2 * BLOCK, sigma, np.int16)))

    def before(self, at: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Among the first ``at`` letters: how many are ``letter``, how many are smaller."""
        block = at // BLOCK
        rest = self.padded[(block * BLOCK)[:, None] + np.arange(BLOCK)]
        open_ = np.arange(BLOCK) < (at - block * BLOCK)[:, None]
        same = self.smaller[block, letter + 1] - self.smaller[block, letter] + ((rest == letter[:, None]) & open_).sum(axis=1)
        return same.astype(np.int64), (self.smaller[block, letter] + ((rest < letter[:, None]) & open_).sum(axis=1)).astype(np.int64)


def _sorted_suffixes(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by ranks of twice as many letters in each turn until all differ."""
    n = len(text)
    rank, width = text.copy(), 1
    while True:
        later = np.zeros(n, np.int64)
        later[:-width] = rank[width:] + 1
        key = rank * (n + 2) + later
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2


def near_words(index: WordIndex, questions: list[str], left: bool) -> tuple[np.ndarray, np.ndarray]:
    """(question number, word number) one edit apart that share the question's half.

    With ``left`` the half is the first len // 2 letters and the search extends to the right; otherwise it is the rest,
    and the search extends to the left.
    """
    found = []
    by_length: dict[int, list[int]] = {}
    for n, q in enumerate(questions):
        if all(c in index.code for c in (q[: len(q) // 2] if left else q[len(q) // 2 :])):
            by_length.setdefault(len(q), []).append(n)
    for length, numbers in by_length.items():
        for at in range(0, len(numbers), QUESTIONS_AT_ONCE):
            who = np.array(numbers[at : at + QUESTIONS_AT_ONCE])
            # Letters in the order of the search; a letter that the index doesn't have matches nothing.
            text = np.array([[index.code.get(c, 0) for c in questions[n]] for n in who.tolist()], np.int64)
            half = length // 2 if left else length - length // 2
            found.append(_one_error(index, who, text if left else text[:, ::-1], half, left))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate([f[0] * len(index.forward.bwt) + f[1] for f in found]))
    return pairs // len(index.forward.bwt), pairs % len(index.forward.bwt)


def _one_error(index: WordIndex, who: np.ndarray, text: np.ndarray, half: int, left: bool) -> tuple[np.ndarray, np.ndarray]:
    """Exact steps over the half, then one step a letter for all intervals at once, with and without their error."""
    length, outward = text.shape[1], not left
    nothing = np.empty(0, np.int64)

    def only(held, *columns):
        return [c[held] for c in columns]

    def step(columns, letters):
        """Columns (three of the interval, question, ...) one letter on; what has no place in the index goes."""
        columns = only(letters > 0, *columns)
        grown = index.extend(tuple(columns[:3]), letters[letters > 0], outward)
        return only(grown[2] > 0, *grown, *columns[3:])

    exact = step([*index.whole(len(who)), np.arange(len(who))], np.ones(len(who), np.int64))
    for at in range(half):
        exact = step(exact, text[exact[3], at])
    found, changed, at = [], [nothing] * 5, half
    while len(exact[3]) or len(changed[3]):
        if len(exact[3]):
            next_to, letter = index.branches(tuple(exact[:3]), outward)
            grown = [*index.extend(tuple(c[next_to] for c in exact[:3]), letter, outward), exact[3][next_to]]
            fresh = [[*grown, np.full(len(letter), at)]]  # one more letter
            if at < length:
                fresh.append([*exact, np.full(len(exact[3]), at + 1)])  # one letter less
                other = letter != text[grown[3], at]
                fresh.append([*only(other, *grown), np.full(int(other.sum()), at + 1)])
                exact = step(exact, text[exact[3], at])
            else:
                exact = [nothing] * 4
            changed = [np.concatenate(c) for c in zip(changed, *fresh)]
            at += 1
        done = changed[4] >= length
        ended = step(only(done, *changed), np.ones(int(done.sum()), np.int64))
        found.append((who[ended[3]], ended[0] - index.first))
        changed = only(~done, *changed)
        changed = step(changed, text[changed[3], changed[4]])
        changed[4] = changed[4] + 1
    if not found:
        return nothing, nothing
    numbers, words = (np.concatenate(x) for x in zip(*found))
    return numbers, words


def _halves(word: Column, least: int) -> Column:
    """Rows (left, half, asks): the word's halves and those of words one letter shorter or longer."""
    n = F.char_length(word)
    rows = []
    for left in (True, False):
        for other in (0, -1, 1):
            # Half of a word of n + other letters, counted from this word's own end.
            k = F.floor((n + other) / 2) if left else n + other - F.floor((n + other) / 2)
            half = F.substring(word, F.lit(1), k.cast("int")) if left else F.right(word, k.cast("int"))
            rows.append(F.when(n + other >= least, F.struct(F.lit(left).alias("left"), half.alias("half"))))
    own = F.array(rows[0], rows[3])
    every = F.filter(F.array_distinct(F.array(*rows)), lambda r: r.isNotNull())
    return F.transform(every, lambda r: F.struct(r["left"].alias("left"), r["half"].alias("half"), F.array_contains(own, r).alias("asks")))


def near_pairs(words: DataFrame, at_once: int = WORDS_AT_ONCE, least: int = LEAST_LENGTH) -> DataFrame:
    """(word, near, near_n): all pairs of different words one edit apart, both ways; words has word, n.

    No word may be shorter than ``least``.
    """
    rows = words.select("word", "n", F.explode(_halves(F.col("word"), least)).alias("r")).select("word", "n", "r.left", "r.half", "r.asks")
    large = rows.groupBy("left", "half").count().where(F.col("count") > at_once)
    large = saved(large.select("left", "half", F.ceil(F.col("count") / at_once).cast("int").alias("pieces")), "spelling-large-groups")
    rows = rows.join(large, ["left", "half"], "left").withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("pieces", F.lit(1))).cast("int"))
    # A question goes to every piece of its group, a word of the index to one.
    everywhere = F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)
    dealt = rows.select(
        "left", "half", "word", "n", "asks", "own",
        F.explode(F.when(F.col("asks"), everywhere).otherwise(F.array("own"))).alias("piece"),
    ).select("left", "half", "piece", "word", "n", "asks", (F.col("piece") == F.col("own")).alias("held"))

    def searched(rows):
        left, words_, counts, asks, held = rows
        known = dict(sorted((w, n) for w, n, h in zip(words_, counts, held) if h))
        if not known:
            return
        index, names, numbers = WordIndex(list(known)), list(known), list(known.values())
        for side in (True, False):
            asked = list(dict.fromkeys(w for w, a, s in zip(words_, asks, left) if a and s == side))
            if asked:
                q, w = near_words(index, asked, side)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([asked[i] for i in q.tolist()], pa.string()), pa.array([names[i] for i in w.tolist()], pa.string()),
                     pa.array([numbers[i] for i in w.tolist()], pa.int64())], ["word", "near", "near_n"],
                )

    def task(batches):
        rows, key = [[] for _ in range(5)], None
        for batch in batches:
            left, half, piece, *rest = (c.to_pylist() for c in batch.columns)
            columns, at = [left, *rest], 0
            for n, k in enumerate(zip(left, half, piece)):
                if k != key:
                    for r, c in zip(rows, columns):
                        r.extend(c[at:n])
                    at, key = n, k
                    # Whole groups are searched together once there are enough words.
                    if len(rows[0]) >= at_once:
                        yield from searched(rows)
                        rows = [[] for _ in range(5)]
            for r, c in zip(rows, columns):
                r.extend(c[at:])
            # All words of the group are there, and questions keep coming.
            if len(rows[0]) >= 4 * at_once and not rows[4][-1]:
                yield from searched(rows)
                kept = [(s, w, n, False, True) for s, w, n, h in zip(*rows[:3], rows[4]) if h]
                rows = [list(c) for c in zip(*kept)] if kept else [[] for _ in range(5)]
        yield from searched(rows)

    # Each task has a few indexes to build, however many words there are.
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, -(-4 * words.count() // WORDS_AT_ONCE))
    dealt = dealt.repartition(tasks, "left", "half", "piece").sortWithinPartitions("left", "half", "piece", F.col("held").desc())
    found = dealt.mapInArrow(task, "word string, near string, near_n bigint").where("word <> near")
    # Pairs are found from several halves and places of the error.
    return found.repartition("word").dropDuplicates(["word", "near"])


def variants(
    docs: DataFrame, ratio: int = RATIO, at_once: int = WORDS_AT_ONCE, least: int = LEAST_LENGTH, count: int = LEAST_COUNT, one_in: int = DELETE_ONE_IN
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary."""
    words = saved(vocabulary(docs, least, count, one_in), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = saved(near_pairs(words, at_once, least).groupBy("word").agg(best, F.count("*").alias("n_near")), "spelling-near")
    form_n = -F.col("best.less")
    leads = form_n >= ratio * F.col("n")
    named = saved(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(leads, F.col("best.form")).alias("form"), F.when(leads, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Every link multiplies the count, so paths are short; each round doubles the steps taken.
    roots = named.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = saved(roots.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "spelling-roots")
        roots = moved.select("word", "root")
        if not moved.where("_moved").take(1):
            break
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
