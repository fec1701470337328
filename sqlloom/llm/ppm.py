"""Language-model scores by prediction by partial matching over bytes, with a word unigram beside it.

The byte trie is pretrained: counts of every byte after its last five bytes, over all training
texts, merged in Spark.  A byte is coded in the longest context that has seen it; a context that
hasn't seen it codes an escape with chance u / 2n for u different bytes in n (each byte seen c times
gets (2c - 1) / 2n), and the next shorter context leaves out the bytes that the longer one has
seen (symbol exclusion).  Because a pretrained trie doesn't change while it codes, both the
chance of a byte after a context and the cost of an escape are fixed numbers, which stand in hash
tables by order; texts are scored many bytes at a time.  Texts start after, and end with, the
byte 255, which UTF-8 never holds.

Trie nodes for contexts of up to two bytes are bounded by the alphabet and are broadcast.  Longer contexts
grow with the corpus and stay in Spark: a block's distinct grams go to the shuffle once, meet the training
grams with the same three bytes of context there, which hold all that longer contexts need, and come back to
the block with their chances.  No context is left out.

The unigram needs the training count of every word of every document.  Documents are
dealt into blocks of about ``BLOCK_BYTES``; a block's distinct words go to the shuffle once, meet the
counts of other blocks there, and come back to the block, which then holds at most its own
vocabulary.  A word that every document has costs one row a block.

Defined cases: a null text is empty: one end token, and one end byte in the model; a null doc_id is
never held out and its crc is that of an empty text; repeated rows train and score each by
itself; without training tokens scores follow the formulas with N = V = 0; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlloom.llm.common import BLANKS, forget, saved, text_bytes

BLOCK_BYTES = 32 << 20
FOLDS, HELD_FOLD = 5, 1
EDGE = 255
END_TOKEN = np.uint64(0x452821E638D01377)  # stands among the hashes of words
FACTOR = 0x9E3779B97F4A7C15
LONG_WORD = 64
HASHED_AT_ONCE = 1 << 21
MERGE_AT = 1 << 22
ORDER = 5
BROADCAST_ORDER = 2  # up to this context length
SCORED_AT_ONCE = 1 << 19
GRAMS_AT_ONCE = 1 << 19
HEAVY = 1 << 22  # rows that one context may bring to a task
_IS_BLANK = np.isin(np.arange(256), [*BLANKS.encode()])
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of the lowest n bytes


def blocks_of(docs: DataFrame) -> DataFrame:
    """(block, doc_id, held_out, text): docs in written blocks of bounded size, texts as lower-case bytes."""

    def task(batches):
        part, block, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            texts = [t.lower() for t in batch.column(2).to_pylist()]
            numbers = []
            for t in texts:
                if size + len(t) > BLOCK_BYTES and size:
                    block, size = block + 1, 0
                numbers.append((part << 32) + block)
                size += len(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
                ["block", "doc_id", "held_out", "text"],
            )

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), text_bytes("text"))
    return saved(rows.mapInArrow(task, "block bigint, doc_id bigint, held_out boolean, text binary"), "ppm-blocks")


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _padded(text: bytes) -> bytes:
    return bytes((EDGE,) * ORDER) + text + bytes((EDGE,))


def _grams(data: np.ndarray) -> np.ndarray:
    """Every byte from ``ORDER`` on with the bytes before it, the byte itself in the lowest 8 bits."""
    n = len(data) - ORDER
    keys = np.zeros(n, np.uint64)
    for k in range(ORDER + 1):
        keys = keys << np.uint64(8) | data[k : k + n]
    return keys


def _distinct_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different grams of padded texts, and their counts."""
    grams = _grams(np.frombuffer(b"".join(texts), np.uint8))
    # A gram that reaches over the end of a text has its end byte in the context.
    ends = np.cumsum([*map(len, texts)])
    inside = np.ones(ends[-1], bool)
    for k in range(ORDER):
        inside[ends - 1 - k] = False
    found = np.sort(grams[inside[: len(grams)]])
    first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
    return found[first], np.diff(np.append(first, len(found)))


def gram_counts(blocks: DataFrame) -> DataFrame:
    """(gram, n): how often a byte (lowest 8 bits) follows the bytes before it, over all training texts."""

    def task(batches):
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting, held = [], 0

        def fold():
            found, uses = _distinct_grams(waiting)
            return _merged(np.concatenate((keys, found)), np.concatenate((counts, uses)))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append(_padded(text))
                held += len(waiting[-1])
                if held > MERGE_AT:
                    keys, counts = fold()
                    waiting, held = [], 0
        if waiting:
            keys, counts = fold()
        for at in range(0, len(keys), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(keys[part].view(np.int64)), pa.array(counts[part])], ["gram", "n"])

    return blocks.where("not held_out").select("text").mapInArrow(task, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_rows(blocks: DataFrame) -> DataFrame:
    """(block, gram): each block's distinct grams, of all its texts."""

    def task(batches):
        grams, waiting, held, now = np.empty(0, np.uint64), [], 0, None

        def fold():
            return np.union1d(grams, _distinct_grams(waiting)[0])

        def rows():
            for at in range(0, len(grams), 1 << 16):
                part = grams[at : at + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), now, np.int64)), pa.array(part)], ["block", "gram"])

        for batch in batches:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != now:
                    if waiting:
                        grams = fold()
                    yield from rows()
                    grams, waiting, held, now = grams[:0], [], 0, block
                waiting.append(_padded(text))
                held += len(waiting[-1])
                if held > MERGE_AT:
                    grams = fold()
                    waiting, held = [], 0
        if waiting:
            grams = fold()
        yield from rows()

    return blocks.select("block", "text").mapInArrow(task, "block bigint, gram bigint")


class HashTable:
    """Numbers by keys other than ``EMPTY``: open addressing, half full at most, looked up many at a time."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, keys: np.ndarray, values: np.ndarray, kind: type = np.float32):
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, self.EMPTY), np.zeros(1 << bits, kind)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == self.EMPTY
            slots, taker = np.unique(at[left[free]], return_index=True)
            taker = left[free][taker]
            self.keys[slots], self.values[slots] = keys[taker], values[taker]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = at[left] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a key is known, its number or 0)."""
        at = self._slot(keys)
        found = self.keys[at]
        known = found == keys
        values = np.where(known, self.values[at], self.values.dtype.type(0))
        left = np.flatnonzero(~known & (found != self.EMPTY))
        while len(left):
            at[left] = at[left] + 1 & self.mask
            found = self.keys[at[left]]
            hit = left[found == keys[left]]
            known[hit], values[hit] = True, self.values[at[hit]]
            left = left[(found != keys[left]) & (found != self.EMPTY)]
        return known, values


class ByteModel:
    """log10 chance of every byte after its context: a table of chances and one of escapes for each order."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray]], shorter: ByteModel | None = None):
        """orders: for context lengths 0, 1, ... the grams of context and byte, and their counts; those of a shorter model come first."""
        self.tables: list[tuple[HashTable, HashTable]] = list(shorter.tables) if shorter else []
        for order, (grams, counts) in enumerate(orders, len(self.tables)):
            grams = grams.astype(np.uint64)
            contexts, row = np.unique(grams >> np.uint64(8), return_inverse=True)
            n, u = np.bincount(row, counts, len(contexts)), np.bincount(row, minlength=len(contexts))
            below = 10.0 ** self.chances(grams & np.uint64((1 << 8 * max(order, 1)) - 1))
            # What the shorter context leaves for bytes that this one hasn't seen.
            left = 1 - np.bincount(row, below, len(contexts))
            escape = np.where(left > 1e-9, u / (2 * n), 0.0) if len(n) else n
            own = (2 * counts - 1) / (2 * n[row] - np.where(escape > 0, 0, u)[row])
            cost = np.log10(np.where(escape > 0, escape, 1e-300) / np.maximum(left, 1e-9))
            self.tables.append((HashTable(grams, np.log10(own)), HashTable(contexts, cost)))

    def chances(self, keys: np.ndarray) -> np.ndarray:
        """log10 chance of the lowest byte of each key after the bytes above it, as far as orders reach."""
        total = np.zeros(len(keys))
        left = np.arange(len(keys))
        for order in range(len(self.tables) - 1, -1, -1):
            grams, escapes = self.tables[order]
            own = keys[left] & np.uint64((1 << 8 * (order + 1)) - 1)
            known, value = grams.get(own)
            total[left] += value
            left, own = left[~known], own[~known]
            if not len(left):
                return total
            total[left] += escapes.get(own >> np.uint64(8))[1]
        total[left] += math.log10(1 / 256)
        return total

    def log10(self, texts: list[bytes]) -> np.ndarray:
        """log10 chance of each text with its end, scored in pieces of bounded size."""
        sums, waiting, numbers, held = np.zeros(len(texts)), [], [], 0

        def score():
            data = np.frombuffer(b"".join(waiting), np.uint8)
            sizes = np.array([*map(len, waiting)])
            values = self.chances(_grams(data))
            # A piece's first ORDER bytes are context only.
            starts = np.cumsum(sizes) - sizes
            running = np.concatenate(([0.0], np.cumsum(values)))
            np.add.at(sums, numbers, running[starts + sizes - ORDER] - running[starts])

        for number, text in enumerate(texts):
            text = _padded(text)
            for at in range(0, len(text) - ORDER, SCORED_AT_ONCE):
                waiting.append(text[at : at + SCORED_AT_ONCE + ORDER])
                numbers.append(number)
                held += len(waiting[-1])
                if held > SCORED_AT_ONCE:
                    score()
                    waiting, numbers, held = [], [], 0
        if waiting:
            score()
        return sums


class BlockModel(ByteModel):
    """The chances of a block's own grams, as ``gram_chances`` has sent them."""

    def __init__(self, parts: list[bytes]):
        sizes = [len(p) // 12 for p in parts]
        keys = [np.frombuffer(p, np.uint64, n) for p, n in zip(parts, sizes)]
        values = [np.frombuffer(p, np.float32, n, 8 * n) for p, n in zip(parts, sizes)]
        self.table = HashTable(np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0, np.float32), *values]))

    def chances(self, keys: np.ndarray) -> np.ndarray:
        """As in ByteModel; 0 for a gram that no text of the block has."""
        return self.table.get(keys)[1].astype(float)


def _collected_model(grams: DataFrame, longest: int) -> ByteModel:
    orders = []
    for order in range(longest + 1):
        own = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1)).alias("gram")
        counted = grams.groupBy(own).agg(F.sum("n").alias("n"))
        table = counted.toArrow()
        orders.append((table["gram"].to_numpy(), table["n"].to_numpy().astype(float)))
    return ByteModel(orders)


def byte_model(blocks: DataFrame) -> ByteModel:
    """All orders trained on the texts that aren't held out, in the driver's memory: for small tables, ``scores`` doesn't use it."""
    return _collected_model(saved(gram_counts(blocks), "ppm-grams"), ORDER)


def gram_chances(blocks: DataFrame, grams: DataFrame) -> DataFrame:
    """(block, chances): log10 chances of each block's grams after all training texts, packed for ``BlockModel``; several rows a block.

    Grams meet the training counts by context.  A context that very many blocks ask for is dealt out over several tasks by
    block, and its training counts, which are bounded by the bytes that may follow, go to each of them.
    """
    shorter = blocks.sparkSession.sparkContext.broadcast(_collected_model(grams, BROADCAST_ORDER))
    # Training grams have no block; they come before the grams that ask for them.
    context = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (BROADCAST_ORDER + 1)) - 1))
    asked = gram_rows(blocks).withColumn("n", F.lit(0).cast("bigint"))
    # A block asks for a gram at most once, so a context's training grams times the blocks bound what is asked of it.
    per_context = grams.groupBy(context.alias("context")).agg(F.count("*").alias("grams"))
    n_blocks = max(1, blocks.select("block").distinct().count())
    pieces = F.ceil(F.col("grams") * n_blocks / HEAVY).cast("int")
    large = saved(per_context.select("context", pieces.alias("pieces")).where("pieces > 1"), "ppm-large-contexts")
    training, first = grams.select(F.lit(-1).cast("bigint").alias("block"), "gram", "n"), F.lit(0)
    if large.isEmpty():
        rows = training.unionByName(asked).withColumn("piece", first)
    else:
        training, asked = (rows.join(large, context == F.col("context"), "left") for rows in (training, asked))
        every = F.explode(F.sequence(first, F.coalesce("pieces", F.lit(1)) - 1))
        one = F.pmod(F.xxhash64("block"), F.coalesce("pieces", F.lit(1))).cast("int")
        rows = training.select("block", "gram", "n", every.alias("piece")).unionByName(asked.select("block", "gram", "n", one.alias("piece")))

    def task(batches):
        waiting, held = [], 0
        known, uses = np.empty(0, np.uint64), np.empty(0, np.int64)  # of the context that may go on

        def settled():
            nonlocal known, uses
            block, gram, n, _ = (np.concatenate(x) for x in zip(*waiting))
            training, gram = block < 0, gram.view(np.uint64)
            # A task may get several pieces of a context, each with the same training counts.
            known, place = np.unique(np.concatenate((known, gram[training])), return_index=True)
            uses = np.concatenate((uses, n[training]))[place]
            asked, block = gram[~training], block[~training]
            if len(asked):
                orders = []
                for order in range(BROADCAST_ORDER + 1, ORDER + 1):
                    keys, counts = _merged(known & np.uint64((1 << 8 * (order + 1)) - 1), uses)
                    orders.append((keys, counts.astype(float)))
                order = np.argsort(block, kind="stable")
                asked, block = asked[order], block[order]
                values = ByteModel(orders, shorter.value).chances(asked).astype(np.float32)
                cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
                parts = [asked[a:b].tobytes() + values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), pa.array(parts, pa.binary())], ["block", "chances"])
            mask = np.uint64((1 << 8 * (BROADCAST_ORDER + 1)) - 1)
            last = known >> np.uint64(8) & mask == gram[-1] >> np.uint64(8) & mask
            known, uses = known[last], uses[last]

        for batch in batches:
            if batch.num_rows:
                waiting.append([c.to_numpy() for c in batch.columns])
                held += batch.num_rows
            if held > GRAMS_AT_ONCE:
                yield from settled()
                waiting, held = [], 0
        if waiting:
            yield from settled()

    placed = rows.repartition(context, "piece").sortWithinPartitions(context, "piece", F.col("block") >= 0).select("block", "gram", "n", "piece")
    return placed.mapInArrow(task, "block bigint, chances binary")


def _token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all tokens of all texts, the end of each text last, number of tokens of each text).

    A word's hash takes its length and eight bytes at a time; words over ``LONG_WORD`` bytes are hashed one by one.
    """
    data = b" ".join([*texts, bytes(8)])  # a blank behind each text, and room for the last eight bytes
    codes = np.frombuffer(data, np.uint8)[: len(data) - 8]
    edges = np.flatnonzero(np.diff(_IS_BLANK[codes].view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    starts, ends = edges[::2], edges[1::2]
    size = ends - starts
    hashes = size.astype(np.uint64) * np.uint64(FACTOR)
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    left = np.flatnonzero(size <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        left = left[size[left] > at]
        if not len(left):
            break
        limb = eight[starts[left] + at] & _LOW_BYTES[np.minimum(size[left] - at, 8)]
        h = (hashes[left] ^ limb) * np.uint64(FACTOR)
        hashes[left] = h ^ h >> np.uint64(32)
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    hashes[hashes == HashTable.EMPTY] = 0
    lengths = np.array([*map(len, texts)])
    upto = np.searchsorted(starts, np.cumsum(lengths + 1))  # words up to the end of each text
    tokens = np.empty(len(hashes) + len(texts), np.uint64)
    is_word = np.ones(len(tokens), bool)
    is_word[upto + np.arange(len(texts))] = False
    tokens[is_word], tokens[~is_word] = hashes, END_TOKEN
    return tokens, np.diff(upto, prepend=0) + 1


def _pieces(texts: list[bytes]) -> list[slice]:
    """Slices of texts of about ``HASHED_AT_ONCE`` bytes; each text is in one of them."""
    cuts, held = [0], 0
    for k, text in enumerate(texts):
        if held and held + len(text) > HASHED_AT_ONCE:
            cuts.append(k)
            held = 0
        held += len(text)
    return [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(texts)]) if a < b]


def word_rows(blocks: DataFrame) -> DataFrame:
    """(block, word, n): a block's distinct tokens as 64-bit hashes, with their training count there."""

    def task(batches):
        words, counts, now = np.empty(0, np.uint64), np.empty(0, np.int64), None

        def rows():
            for at in range(0, len(words), 1 << 16):
                part = slice(at, at + (1 << 16))
                own = words[part].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), now, np.int64)), pa.array(own), pa.array(counts[part])], ["block", "word", "n"])

        for batch in batches:
            block, trains = batch.column(0).to_numpy(), ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            texts = batch.column(2).to_pylist()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if block[a] != now:
                    yield from rows()
                    words, counts, now = words[:0], counts[:0], block[a]
                for part in _pieces(texts[a:b]):
                    found, n = _token_hashes(texts[a:b][part])
                    uses = np.repeat(trains[a:b][part].astype(np.int64), n)
                    words, counts = _merged(np.concatenate((words, found)), np.concatenate((counts, uses)))
        yield from rows()

    return blocks.select("block", "held_out", "text").mapInArrow(task, "block bigint, word bigint, n bigint")


def scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    blocks = blocks_of(docs)
    grams = saved(gram_counts(blocks), "ppm-grams")
    chances = saved(gram_chances(blocks, grams), "ppm-chances")
    forget(grams)
    own = saved(word_rows(blocks), "ppm-block-words")
    totals = saved(own.groupBy("word").agg(F.sum("n").alias("total")), "ppm-word-totals")
    words = saved(own.select("block", "word").distinct().join(totals, "word"), "ppm-words")
    train, seen = totals.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count_if(F.col("total") > 0)).first()
    forget(own, totals)
    scale = math.log10(train + 0.5 * (seen + 1))
    empty = {"word": "bigint", "total": "bigint", "doc_id": "bigint", "held_out": "boolean", "text": "binary"}

    def of_kind(kind, rows, **own):
        return rows.select("block", F.lit(kind).alias("kind"), *[F.col(own.get(c, c)).alias(c) if own.get(c, c) in rows.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()])

    mixed = of_kind(0, words).unionByName(of_kind(1, chances, text="chances")).unionByName(of_kind(2, blocks))

    def task(batches):
        words, parts, known, model, now = [], [], None, None, None
        for batch in batches:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist(), len(block)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if block[a] != now:
                    words, parts, known, model, now = [], [], None, None, block[a]
                if kind[a] == 0:
                    words.append([batch.column(k)[a:b].to_numpy(zero_copy_only=False) for k in (2, 3)])
                    continue
                if kind[a] == 1:
                    parts += batch.column(6)[a:b].to_pylist()
                    continue
                if model is None:
                    keys, totals = (np.concatenate(x).astype(np.int64) for x in zip(*words))
                    known, model, words, parts = HashTable(keys.view(np.uint64), totals, np.float64), BlockModel(parts), [], []
                texts, columns = batch.column(6)[a:b].to_pylist(), []
                for part in _pieces(texts):
                    tokens, n = _token_hashes(texts[part])
                    uses = known.get(tokens)[1]
                    first = np.cumsum(n) - n
                    columns.append((n, np.add.reduceat((uses > 0).astype(np.int64), first), np.add.reduceat(np.log10(uses + 0.5), first) - n * scale))
                n, found, base = map(np.concatenate, zip(*columns))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(4)[a:b], batch.column(5)[a:b], pa.array(n, pa.int64()), pa.array(found, pa.int64()),
                        pa.array([train] * (b - a), pa.int64()), pa.array(base, pa.float64()), pa.array(model.log10(texts)),
                    ],
                    names,
                )

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return (
        mixed.repartition(max(1, blocks.select("block").distinct().count()), "block").sortWithinPartitions("block", "kind")
        .mapInArrow(task, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    )
