"""Similarity join on n-gram sets: T-occurrence search with DivideSkip, exact, in blocks of close families.

A text's set holds a 64-bit hash of each distinct five-word shingle.  Two sets link when their Jaccard
similarity reaches ``PERCENT``.  Then they share at least T tokens, T being that part of the larger one's size.

1. Filter.  In one order of all tokens, both sets' first size - T + k tokens share k of them at least.  So only those
   tokens are shuffled, and a set stays only if enough of them occur elsewhere.  Tokens that are frequent in a bounded sample of
   texts come last in the order and need no count; that order is a matter of cost, not of results.
2. Families.  What stays is cut again, rarest tokens first; sets that share one of the tokens left are a family.  No link leaves its
   family.
3. Search.  Families come to tasks in blocks of a bounded number of tokens.  A block is an inverted index; for each set, short lists are
   merged as sorted runs, and sets that occur often enough there are looked up in the long lists by binary search.  A task
   sends the links that join components, never all pairs.
4. Large families.  Their blocks also search some pivot sets, the same for all blocks; after that, only sets outside the family's largest
   component are searched in the family's other blocks.  So every pair of sets either met in a block or was in one component
   before.

Defined cases: null and empty texts have the empty set, which links with nothing; a text of fewer words than a shingle has one token;
repeated rows and copies share their set; a null doc_id never names a component (a component of such rows only has a null id); an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.llm.common import saved, text_bytes
from sqlloom.llm.simhash import components

SHINGLE = 5
PERCENT = 80
SEED = 42
EXTRA = 20  # percent of a set's size that the first filter asks for
TOKENS_AT_ONCE = 1 << 20
PIVOTS = 64
# Texts whose tokens tell what is frequent, and how many of them a frequent token is in.
SAMPLE_TEXTS = 4096
FREQUENT = 8
# Fixed odd factors that tell a word's place in the shingle.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def token_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted different hashes of all runs of ``shingle`` words, as signed numbers."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    mixed = np.full(n, width, np.uint64)
    for k in range(width):
        mixed += hashes[k : k + n] * FACTORS[k % len(FACTORS)]
        mixed ^= mixed >> np.uint64(31)
        mixed *= FACTORS[-1]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def _least_overlap(size):
    """Tokens that a set shares with any set it links to, at least."""
    return -(-size * PERCENT // 100)


def _extra(size):
    return -(-size * EXTRA // 100)


def _asked(size):
    """Tokens among the first ones that linked sets share at least: those of the smallest set that may link."""
    return np.maximum(1, _extra(_least_overlap(size)))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def frequent_tokens(docs: DataFrame, texts: int = SAMPLE_TEXTS, least: int = FREQUENT) -> np.ndarray:
    """Tokens that many of the sampled texts hold, sorted by how many, then by value.

    The sample takes texts by their hash, so copies count once; its size and that of the result are bounded.
    """
    n = docs.count()
    drawn = docs.select(text_bytes("text").alias("text"), _text_hash(F.col("text")).alias("hash")).where(
        F.pmod(F.xxhash64("hash"), F.lit(max(1, -(-n // texts)))) == 0
    ).dropDuplicates(["hash"])

    def task(batches):
        for batch in batches:
            found = [token_set(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found]))], ["token"])

    counts = drawn.select("text").mapInArrow(task, "token bigint").groupBy("token").count().where(F.col("count") >= least)
    # At most SAMPLE_TEXTS / FREQUENT times the tokens of a text.
    found = sorted((r["count"], r["token"]) for r in counts.collect())
    return np.array([t for _, t in found], np.int64)


def first_tokens(frequent: np.ndarray) -> Callable[[np.ndarray], bytes]:
    """A function from a set to its first tokens in the common order, as many as the filter asks for."""
    known, place = np.sort(frequent), np.argsort(frequent)

    def first(tokens):
        if not len(tokens):
            return b""
        size = len(tokens)
        keep = min(size, size - _least_overlap(size) + _extra(size))
        if len(known):
            at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
            turn = np.where(known[at] == tokens, place[at] + 1, 0)
            tokens = tokens[np.argsort(turn, kind="stable")]
        return tokens[:keep].tobytes()

    return first


def token_sets(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, mark, size, head): mark names the set, head holds its first tokens in the common order."""
    first = first_tokens(frequent)

    def task(batches):
        for batch in batches:
            sets = [token_set(t) for t in batch.column(2).to_pylist()]
            marks = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(marks, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([first(s) for s in sets], pa.binary()),
                ],
                ["doc_id", "text_hash", "mark", "size", "head"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_hash(F.col("text")).alias("text_hash"), text_bytes("text"))
    return rows.mapInArrow(task, "doc_id bigint, text_hash bigint, mark bigint, size bigint, head binary")


def shared_tokens(heads: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(mark, token, held): the first tokens that several sets hold, with their number of sets.

    Frequent tokens count as shared without a look, so their rows are dealt out by set as well.
    """
    known = np.sort(frequent)

    def is_known(tokens):
        if not len(known):
            return np.zeros(len(tokens), bool)
        return known[np.minimum(np.searchsorted(known, tokens), len(known) - 1)] == tokens

    def spread(batches):
        for batch in batches:
            found = [np.frombuffer(h, np.int64) for h in batch.column(1).to_pylist()]
            tokens = np.concatenate([np.empty(0, np.int64), *found])
            marks = np.repeat(batch.column(0).to_numpy(), [len(f) for f in found])
            salt = np.where(is_known(tokens), marks & 0x7FFF, 0).astype(np.int16)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(marks), pa.array(salt)], ["token", "mark", "salt"])

    def settled(tokens, marks):
        _, inverse, n = np.unique(tokens, return_inverse=True, return_counts=True)
        n = np.where(is_known(tokens), 1 << 40, n[inverse])
        kept = n > 1
        return pa.RecordBatch.from_arrays([pa.array(marks[kept]), pa.array(tokens[kept]), pa.array(n[kept])], ["mark", "token", "held"])

    def repeated(batches):
        tokens = marks = np.empty(0, np.int64)
        for batch in batches:
            tokens = np.concatenate((tokens, batch.column(0).to_numpy()))
            marks = np.concatenate((marks, batch.column(1).to_numpy()))
            cut = int(np.searchsorted(tokens, tokens[-1], "left")) if len(tokens) else 0
            if cut:
                yield settled(tokens[:cut], marks[:cut])
                tokens, marks = tokens[cut:], marks[cut:]
            if len(tokens) and is_known(tokens[:1])[0]:
                yield settled(tokens, marks)
                tokens = marks = tokens[:0]
        if len(tokens):
            yield settled(tokens, marks)

    dealt = heads.mapInArrow(spread, "token bigint, mark bigint, salt smallint").repartition("token", "salt").sortWithinPartitions("token")
    return dealt.select("token", "mark").mapInArrow(repeated, "mark bigint, token bigint, held bigint")


def filter_links(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(a, b): links that span the sets which may link to each other."""
    per_set = shared.groupBy("mark").agg(F.count("*").alias("n")).join(sets.select("mark", "size"), "mark")
    most = F.ceil(F.ceil(F.col("size") * PERCENT / 100) * EXTRA / 100)
    may = per_set.where(F.col("n") >= F.greatest(F.lit(1), most)).select("mark", "size", (F.col("n") - F.greatest(F.lit(1), most) + 1).alias("used"))
    # Linked sets share so many of these tokens that the most frequent ones can be left out.
    order = Window.partitionBy("mark").orderBy("held", "token")
    lists = shared.join(may, "mark").withColumn("turn", F.row_number().over(order)).where("turn <= used").select("mark", "token")
    lists = saved(lists, "jaccard-lists")
    least = lists.groupBy("token").agg(F.min("mark").alias("first"), F.max("mark").alias("last")).where("first < last").select("token", "first")
    return lists.join(least, "token").select(F.col("first").alias("a"), F.col("mark").alias("b")).where("a <> b").distinct()


def families(sets: DataFrame, links: DataFrame) -> DataFrame:
    """(mark, size, family) for the linked sets."""
    roots = components(links)
    named = roots.select(F.col("node").alias("mark"), F.col("root").alias("family"))
    named = named.union(roots.select("root", "root").distinct())
    return saved(named.join(sets.select("mark", "size"), "mark"), "jaccard-families")


class ListIndex:
    """Inverted lists of a block of sets; each list holds set numbers in order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.n = len(sets)
        joined = np.concatenate(sets) if sets else np.empty(0, np.int64)
        self.tokens, inverse = np.unique(joined, return_inverse=True)
        # All lists, one after the other: token number * n + set number.
        self.places = np.sort(inverse * max(self.n, 1) + np.repeat(np.arange(self.n), self.sizes))

    def search(self, tokens: np.ndarray, below: int | None = None) -> np.ndarray:
        """Numbers of the sets, of the first ``below`` ones, that link to the set of these tokens."""
        below, size, n = self.n if below is None else below, len(tokens), self.n
        if not n or not size:
            return np.empty(0, np.int64)
        least = _least_overlap(size)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        own = at[self.tokens[at] == tokens]
        start, end = np.searchsorted(self.places, own * n), np.searchsorted(self.places, own * n + below)
        length = end - start
        own, start, length = own[length > 0], start[length > 0], length[length > 0]
        if len(own) < least:
            return np.empty(0, np.int64)
        # The longest lists are probed: more of them where they are long against the overlap asked for.
        order = np.argsort(length, kind="stable")
        n_long = min(least - 1, int(least / (0.01 * np.log2(length.max() + 1) + 1)))
        short, long = order[: len(order) - n_long], order[len(order) - n_long :]
        ends = np.cumsum(length[short])
        at = np.arange(ends[-1]) - np.repeat(ends - length[short], length[short]) + np.repeat(start[short], length[short])
        # Sorted runs one after the other: a stable sort finds and merges them.
        merged = np.sort(self.places[at] % n, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        found, seen = merged[first], np.diff(np.append(first, len(merged)))
        for number, k in enumerate(long.tolist()):
            kept = seen >= least - (n_long - number)
            if not kept.all():
                found, seen = found[kept], seen[kept]
            if not len(found):
                return found
            places = self.places[start[k] : start[k] + length[k]]
            wanted = own[k] * n + found
            seen = seen + (places[np.minimum(np.searchsorted(places, wanted), len(places) - 1)] == wanted)
        return found[100 * seen >= PERCENT * (size + self.sizes[found] - seen)]


def block_links(marks: list[int], sets: list[np.ndarray], index: ListIndex, label: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the block's components; label is changed in place."""
    links, members = [], {n: [n] for n in range(index.n)}
    for n in range(1, index.n):
        for other in index.search(sets[n], n).tolist():
            small, large = sorted((label[other], label[n]), key=lambda x: len(members[x]))
            if small != large:
                links.append((marks[other], marks[n]))
                moved = members.pop(small)
                label[moved] = large
                members[large] += moved
    return links


def _searched(members: DataFrame, inside: bool) -> DataFrame:
    """(a, b): links of each block; members has family, block, visits, mark, label, tokens.

    Residents of a block are its index; ``inside`` has them searched in it too.  Visitors are searched in it one after the
    other.  Sets with the same label are in one component already.
    """

    def task(batches):
        key, marks, sets, labels, index, links = None, [], [], [], None, []

        def sent():
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])
                links.clear()

        def built():
            own = ListIndex(sets)
            label = np.arange(own.n)
            if inside:
                links.extend(block_links(marks, sets, own, label))
            else:
                label = np.array(labels, np.int64)
            return own, label

        for batch in batches:
            for family, block, visits, mark, of, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, block) != key:
                    if key is not None and index is None:
                        built()
                        yield from sent()
                    key, marks, sets, labels, index = (family, block), [], [], [], None
                own = np.frombuffer(tokens, np.int64)
                if not visits:
                    marks.append(mark)
                    sets.append(own)
                    labels.append(of)
                    continue
                if index is None:
                    index, label = built()
                found = index.search(own)
                if not inside:
                    found = found[label[found] != of]
                _, one_each = np.unique(label[found], return_index=True)
                links.extend((marks[k], mark) for k in found[one_each].tolist())
            yield from sent()
        if key is not None and index is None:
            built()
        yield from sent()

    columns = ["family", "block", "visits", "mark", "label", "tokens"]
    dealt = members.select(*columns).repartition("family", "block").sortWithinPartitions("family", "block", "visits")
    return dealt.mapInArrow(task, "a bigint, b bigint").distinct()


def _with_tokens(docs: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """(mark, tokens) of the members, from one of the texts that have the set."""

    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([token_set(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["mark", "tokens"]
            )

    wanted = members.select("mark").join(sets, "mark").select("mark", F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_hash"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _text_hash(F.col("text")).alias("text_hash"), text_bytes("text").alias("text"))
    own = texts.join(wanted, (F.col("text_hash") == F.col("_hash")) & texts.doc_id.eqNullSafe(F.col("_id")))
    return saved(own.select("mark", "text").mapInArrow(task, "mark bigint, tokens binary").dropDuplicates(["mark"]), "jaccard-tokens")


def set_links(docs: DataFrame, sets: DataFrame, member: DataFrame, tokens_at_once: int = TOKENS_AT_ONCE, pivots: int = PIVOTS) -> DataFrame:
    """(a, b): links between sets whose components are those of all linked pairs; member has mark, size, family."""
    tokens = _with_tokens(docs, sets, member)
    spans = member.groupBy("family").agg(
        F.ceil(F.sum("size") / tokens_at_once).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.count("*") / pivots).cast("bigint").alias("one_in"),
    )
    spans = saved(spans, "jaccard-spans")
    placed = member.join(spans, "family").withColumn("home", F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int"))
    placed = saved(placed.join(tokens, "mark"), "jaccard-members")
    home = placed.select("family", F.col("home").alias("block"), F.lit(False).alias("visits"), "mark", F.lit(0).cast("bigint").alias("label"), "tokens")
    elsewhere = F.explode(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("home"))).alias("block")
    split = placed.where("blocks > 1")

    def visiting(rows, label):
        return rows.select("family", elsewhere, F.lit(True).alias("visits"), "mark", label.alias("label"), "tokens")

    chosen = split.where(F.pmod(F.xxhash64("mark", F.lit(1)), F.col("one_in")) == 0)
    links = saved(_searched(home.unionByName(visiting(chosen, F.lit(0).cast("bigint"))), True), "jaccard-links")
    if not spans.where("blocks > 1").take(1):
        return links
    # Only sets outside the largest component of a family that was split have pairs that haven't met.
    roots = components(links)
    named = split.join(roots.select(F.col("node").alias("mark"), "root"), "mark", "left").withColumn("label", F.coalesce("root", "mark"))
    named = saved(named.select("family", "blocks", "home", "mark", "label", "tokens"), "jaccard-split")
    largest = named.groupBy("family", "label").count().groupBy("family").agg(F.max(F.struct("count", "label")).alias("most"))
    outside = named.join(largest.select("family", F.col("most.label").alias("_largest")), "family").where("label <> _largest")
    there = named.select("family", F.col("home").alias("block"), F.lit(False).alias("visits"), "mark", "label", "tokens")
    more = saved(_searched(there.unionByName(visiting(outside, F.col("label"))), False), "jaccard-more-links")
    return links.unionByName(more)


def similarity_groups(docs: DataFrame, tokens_at_once: int = TOKENS_AT_ONCE, pivots: int = PIVOTS, sample_texts: int = SAMPLE_TEXTS, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs."""
    common = frequent_tokens(docs, sample_texts, frequent)
    every = saved(token_sets(docs, common), "jaccard-sets")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("best")
    sets = saved(every.groupBy("mark").agg(best, F.min("size").alias("size")), "jaccard-marks")
    heads = every.where("size > 0").select("mark", "head").dropDuplicates(["mark"])
    shared = saved(shared_tokens(heads, common), "jaccard-shared")
    roots = components(set_links(docs, sets, families(sets, filter_links(sets, shared)), tokens_at_once, pivots))
    member = roots.select(F.col("node").alias("mark"), "root").union(roots.select("root", "root").distinct())
    lowest = member.join(sets, "mark").groupBy("root").agg(F.min("best.doc_id").alias("low_id"))
    named = member.join(lowest, "root").select("mark", "low_id")
    owner = sets.join(named, "mark", "left").select("mark", F.coalesce("low_id", "best.doc_id").alias("owner_id"))
    owned = every.select("doc_id", "mark", "size").join(owner, "mark")
    return owned.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("owner_id")).otherwise(F.col("doc_id")).alias("component_id"))
