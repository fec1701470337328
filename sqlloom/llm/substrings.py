"""Substring dedup by suffix automata of reference shards and matching statistics.

A word is removed if a window of ``span`` words that covers it also starts in a document with a smaller doc_id.

Automata of a whole corpus can't be broadcast and every document can't be streamed past each of them,
so both sides are first cut down to what can match at all, without losing a window:

1. Anchors.  Each window is represented by the smallest hash among its runs of ``GRAM`` words.  Equal
   windows have equal anchors, and a document has about one anchor in five words.
2. The windows around an anchor make up a stretch of ``2 * span - GRAM`` words at most.  It travels as
   its hash and its place.  Anchors found in one document only are dropped, equal stretches of an
   anchor are told by one of them, and batches combine their own first, so a passage that every
   document holds costs one row a batch.
3. Each different stretch is read once, from the first document that has it, and routed by its
   anchor, so everything that could match meets in one shard.
4. The stretches of a shard make up its suffix automaton, each state of which knows the
   smallest doc_id among its occurrences.  Streaming the stretches through it gives the matching
   statistics; where the match is ``span`` words or longer, the state that holds the last
   ``span`` words names the first document of that window.
5. Every place of a stretch gets its answer by key; windows whose first document is smaller than their
   own are removed.

An anchor with more than ``MAX_STRETCHES`` different stretches (the edge of a passage that very many
documents hold) is routed by anchor and window instead, one window a stretch.

Defined cases: a null text has no words; documents shorter than the span lose nothing; rows without a
doc_id neither lose words nor take any from others; rows with the same doc_id take nothing from
each other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.llm.common import forget, saved, text_bytes

SPAN = 13
GRAM = 5
MAX_STRETCHES = 2000
SHARD_WORDS = 1 << 14
FACTOR = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9
PLACE_BITS = 20


class Anchors:
    """Windows and anchors of texts, from running hashes of their bytes.

    With h(i) the sum of byte[j] * FACTOR^j over j < i, modulo 2^64, the bytes from a to b have
    (h(b) - h(a)) / FACTOR^a as their hash wherever they stand.  Hashes only decide what is compared later.
    """

    def __init__(self, span: int, gram: int):
        self.span, self.gram = span, min(gram, span)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.power) < n:
            steps = np.full(2 * n, FACTOR, np.uint64), np.full(2 * n, pow(FACTOR, -1, 1 << 64), np.uint64)
            for x in steps:
                x[0] = 1
            self.power, self.inverse = (np.cumprod(x, dtype=np.uint64) for x in steps)
        return self.power[:n], self.inverse

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of every stretch: the hash of its anchor, its own hash, its first window, its number of windows."""
        joined = b" ".join(text.split())
        data = np.frombuffer(joined, np.uint8)
        blanks = np.flatnonzero(data == 32)
        starts, ends = np.concatenate(([0], blanks + 1)), np.append(blanks, len(data))
        n = len(starts) - self.span + 1
        if n <= 0 or not joined:
            none = np.empty(0, np.int64)
            return none, none, none, none
        power, inverse = self._powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(data * power, out=sums[1:])

        def hashes(first, last):
            h = (sums[ends[last]] - sums[starts[first]]) * inverse[starts[first]]
            h = (h ^ h >> np.uint64(31)) * np.uint64(MIX)
            return h ^ h >> np.uint64(29)

        words = np.arange(len(starts) - self.gram + 1)
        runs = hashes(words, words + self.gram - 1)
        # The smallest hash of each window, the leftmost among equals: its number stands in the low bits.
        mask = np.uint64((1 << PLACE_BITS) - 1)
        low = runs & ~mask | words.astype(np.uint64) & mask
        wide, width = self.span - self.gram + 1, 1
        while width < wide:
            step = min(width, wide - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        windows = np.arange(n)
        at = windows + ((low & mask).astype(np.int64) - windows) % (1 << PLACE_BITS)
        first = _first_of_runs(at)
        last = np.append(first[1:], n) - 1
        return runs[at[first]].view(np.int64), hashes(first, last + self.span - 1).view(np.int64), first, last - first + 1


def _first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


ROW = "anchor bigint, stretch_hash bigint, doc_id bigint, mark int, start int, n int"
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
NAMES = [c.split()[0] for c in ROW.split(", ")]
# A row that speaks for its stretch, one whose anchor has been seen twice, and one that needs no more.
ASKS, SURE, DECIDED = 0, 1, 2


def _batch(columns, **more) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(columns, KINDS)]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(x) for x in more.values()], NAMES + list(more))


def repeated_stretches(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Stretches whose anchor at least two documents have: (ROW, speaks), one that speaks for each different one."""

    def offered(batches):
        read = Anchors(span, gram)
        for batch in batches:
            parts = []
            for doc_id, mark, text in zip(*[c.to_pylist() for c in batch.columns]):
                h, s, first, n = read(text)
                parts.append((h, s, np.full(len(h), doc_id), np.full(len(h), mark), first, n))
            h, s, d, m, p, n = (np.concatenate(x) for x in zip(*parts))
            if not len(h):
                continue
            order = np.lexsort((p, d, s, h))
            h, s, d, m, p, n = (x[order] for x in (h, s, d, m, p, n))
            run = _first_of_runs(h)
            size = np.diff(np.append(run, len(h)))
            twice = np.repeat(np.minimum.reduceat(d, run) != np.maximum.reduceat(d, run), size)
            state = np.where(twice, DECIDED, ASKS).astype(np.int8)
            speaks = _first_of_runs(h, s)
            state[speaks[twice[speaks]]] = SURE
            # What is decided is dealt out by its place, not by its anchor.
            key = np.where(state == DECIDED, (d * np.int64(1000003) + p) * np.int64(0x9E3779B1), h)
            yield _batch((h, s, d, m, p, n), key=key, state=state)

    def shared(batches):
        wait, again, said = [np.empty(0, np.int64)] * 7, None, None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns[:6]]
            state = batch.column(7).to_numpy()
            decided = state == DECIDED
            if decided.any():
                yield _batch([c[decided] for c in columns], speaks=np.zeros(decided.sum(), bool))
            wait = [np.concatenate((x, c[~decided])) for x, c in zip(wait, [*columns, state])]
            h, s, d, sure = wait[0], wait[1], wait[2], wait[6]
            if not len(h):
                continue
            run = _first_of_runs(h)
            size = np.diff(np.append(run, len(h)))
            repeated = (np.minimum.reduceat(d, run) != np.maximum.reduceat(d, run)) | (np.maximum.reduceat(sure, run) == SURE)
            repeated[0] |= again is not None and h[0] == again
            rows = np.repeat(repeated, size)
            if rows.any():
                found = [c[rows] for c in wait[:6]]
                speaks = np.zeros(len(found[0]), bool)
                speaks[_first_of_runs(found[0], found[1])] = True
                if said == (found[0][0], found[1][0]):
                    speaks[0] = False
                said = found[0][-1], found[1][-1]
                yield _batch(found, speaks=speaks)
            again = h[-1] if repeated[-1] else None
            # A run of one document waits for the next batch; it is no longer than the document.
            left = slice(len(h), None) if repeated[-1] else slice(run[-1], None)
            wait = [c[left] for c in wait]

    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), _mark("text"), text_bytes("text"))
    offers = rows.mapInArrow(offered, f"{ROW}, key bigint, state tinyint")
    return offers.repartition("key").sortWithinPartitions("key", "stretch_hash", "doc_id").mapInArrow(shared, f"{ROW}, speaks boolean")


def _mark(text: str):
    """Tells rows with the same doc_id apart."""
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def stretch_texts(docs: DataFrame, speaking: DataFrame, span: int = SPAN) -> DataFrame:
    """(anchor, stretch_hash, stretch, first_id): the words of each stretch, from the row that speaks for it."""
    wanted = speaking.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("anchor", "stretch_hash", "start", "n")).alias("wanted"))

    def task(batches):
        for batch in batches:
            for doc_id, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                wanted = wanted.values
                joined = b" ".join(text.split())
                blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
                starts, ends = np.concatenate(([0], blanks + 1)), np.append(blanks, len(joined))
                start, n = (wanted.field(k).to_numpy() for k in ("start", "n"))
                words = [joined[a:b] for a, b in zip(starts[start].tolist(), ends[start + n + span - 2].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [wanted.field("anchor"), wanted.field("stretch_hash"), pa.array(words, pa.binary()), pa.array(np.full(len(words), doc_id))],
                    ["anchor", "stretch_hash", "stretch", "first_id"],
                )

    # Equal rows of docs would tell the same words twice.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _mark("text").alias("mark"), text_bytes("text").alias("text"))
    return rows.join(wanted, ["doc_id", "mark"]).select("doc_id", "text", "wanted").mapInArrow(
        task, "anchor bigint, stretch_hash bigint, stretch binary, first_id bigint"
    )


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state knows the first document it occurs in."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [None]

    def _state(self, length: int, next_: dict, link: int) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        self.first.append(None)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word) -> int:
        """A copy of q for the shorter strings that reach it from p."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return new

    def add(self, words: list, doc_id: int) -> None:
        last, first = 0, self.first
        for word in words:
            last = self._extend(last, word)
            if first[last] is None or doc_id < first[last]:
                first[last] = doc_id

    def settle(self) -> None:
        """Hand first documents down to shorter strings, longest first; call after the last add."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up, own = self.link[state], self.first[state]
            if up > 0 and (self.first[up] is None or own < self.first[up]):
                self.first[up] = own

    def firsts(self, words: list, span: int) -> list:
        """For every window of ``span`` words: the first document that has it, None if none does."""
        state = matched = 0
        found = []
        for at, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            if at + 1 < span:
                continue
            if matched < span:
                found.append(None)
                continue
            holder = state
            while self.length[self.link[holder]] >= span:
                holder = self.link[holder]
            found.append(self.first[holder])
        return found


def first_documents(references: DataFrame, span: int = SPAN, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(anchor, mark, firsts) of distinct stretches (anchor, stretch_hash, stretch, first_id)."""

    def shard(rows):
        automaton = SuffixAutomaton()
        split = [(anchor, code, words.split(), first) for anchor, code, words, first in rows]
        for _, _, words, first in split:
            automaton.add(words, first)
        automaton.settle()
        found = [automaton.firsts(words, span) for _, _, words, _ in split]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
            ["anchor", "stretch_hash", "firsts"],
        )

    def task(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                # Shards end between anchors; an anchor has a bounded number of stretches.
                if size > shard_words and row[0] != rows[-1][0]:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += 2 * span
        if rows:
            yield shard(rows)

    ordered = references.select("anchor", "stretch_hash", "stretch", "first_id").repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(task, "anchor bigint, stretch_hash bigint, firsts array<bigint>")


def _single_windows(stretch, span: int):
    """Array of (k, window): each window of a stretch by itself."""
    words = F.split(stretch.cast("string"), " ")
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - span),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice(words, k + 1, span), " ").cast("binary").alias("window")),
    )


def removed_windows(docs: DataFrame, span: int = SPAN, gram: int = GRAM, max_stretches: int = MAX_STRETCHES) -> DataFrame:
    """(doc_id, mark, starts): the windows of each document that occur in an earlier one."""
    found = saved(repeated_stretches(docs, span, gram), "stretches")
    texts = saved(stretch_texts(docs, found.where("speaks"), span), "stretch-texts")
    counts = texts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > max_stretches)
    wide = saved(counts.select("anchor"), "wide-anchors")
    narrow = texts
    if wide.take(1):
        narrow = texts.join(wide, "anchor", "left_anti")
    firsts = first_documents(narrow, span)
    if wide.take(1):
        # The windows of a wide anchor are answered one by one and put together again.
        single = texts.join(wide, "anchor", "left_semi").select("anchor", "stretch_hash", "first_id", F.inline(_single_windows(F.col("stretch"), span)))
        codes = F.xxhash64("anchor", "window").alias("code"), F.xxhash64("window").alias("window_hash")
        single = single.select("*", *codes)
        one = single.groupBy("code", "window_hash").agg(F.min("first_id").alias("first_id"), F.first("window").alias("stretch"))
        answers = first_documents(one.select(F.col("code").alias("anchor"), F.col("window_hash").alias("stretch_hash"), "stretch", "first_id"), span)
        answers = answers.select(F.col("anchor").alias("code"), F.col("stretch_hash").alias("window_hash"), F.get("firsts", F.lit(0)).alias("first"))
        again = single.join(answers, ["code", "window_hash"]).groupBy("anchor", "stretch_hash").agg(F.array_sort(F.collect_set(F.struct("k", "first"))).alias("all"))
        firsts = firsts.unionByName(again.select("anchor", "stretch_hash", F.col("all.first").alias("firsts")))
    firsts = saved(firsts, "first-documents")
    forget(texts)
    earlier = F.filter(F.transform("firsts", lambda f, k: F.when(f < F.col("doc_id"), F.col("start") + k)), lambda s: s.isNotNull())
    hits = found.select("anchor", "stretch_hash", "doc_id", "mark", "start").join(firsts, ["anchor", "stretch_hash"])
    removed = (
        hits.select("doc_id", "mark", earlier.alias("starts"))
        .where(F.size("starts") > 0)
        .groupBy("doc_id", "mark")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )
    removed = saved(removed, "removed-windows")
    forget(found, firsts)
    return removed


def dedup_substrings(docs: DataFrame, span: int = SPAN, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept words joined by blanks, for every row of docs."""
    hits = removed_windows(docs, span, **options)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), _mark("text").alias("_mark"), text_bytes("text").alias("text"))
    joined = rows.join(hits, (F.col("_id") == F.col("doc_id")) & (F.col("_mark") == F.col("mark")), "left").select("_id", "text", "starts")

    def task(batches):
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, starts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = text.split()
                gone = 0
                if starts:
                    edge = np.zeros(len(words) + 1, np.int64)
                    starts = np.array(starts)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + span, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    gone = int(len(words) - stays.sum())
                    kept.append(b" ".join([w for w, s in zip(words, stays.tolist()) if s]))
                else:
                    kept.append(b" ".join(words))
                sizes.append(len(words))
                removed.append(gone)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return joined.mapInArrow(task, "doc_id bigint, n_words bigint, n_removed bigint, kept binary").withColumn("kept", F.col("kept").cast("string"))
