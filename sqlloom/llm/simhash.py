"""Near-duplicates by SimHash: pigeonhole blocks, Hamming check, connected components.

Two 64-bit fingerprints that differ in at most d bits agree in at least b - d of b blocks.
Every choice of b - d blocks is therefore a key under which all close pairs meet (35 keys of 27
or 28 bits for d = 4, b = 7).  Only distinct fingerprints are keyed, so copies of a text cost one
key set; inside a block pairs are compared in sorted runs and leave the task as a spanning
forest, never as pairs.  Blocks above ``MAX_RUN`` go another exact way: fingerprints that
reach a common value by flipping up to d/2 bits each differ in at most d bits, and the reverse
holds too, so grouping by those values finds the same links with a number of rows in
proportion to the block.

Defined cases: a null text is an empty text; a text without words has fingerprint 0 and links
like any other; repeated rows share fingerprint and component; a null doc_id never names a
component (a component of such rows only has a null id); other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlloom.llm.common import joined_labels, saved, text_bytes

SEED = 42
MAX_BITS = 4
BLOCKS = 7
MAX_RUN = 4096
SHINGLE = 4
HASHES_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 18
KEY_SHIFT = 56


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text, as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - width]))
    ends = ends[width - 1 :] - 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), HASHES_AT_ONCE):
        spans = zip(starts[at : at + HASHES_AT_ONCE].tolist(), ends[at : at + HASHES_AT_ONCE].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts)).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row."""

    def task(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text")).mapInArrow(task, "doc_id bigint, fp bigint")


def _block_bits(blocks: int) -> list[list[int]]:
    """Bit numbers of each block; sizes differ by one at most."""
    return [b.tolist() for b in np.array_split(np.arange(64), blocks)]


def _choices(bits: int, blocks: int) -> list[tuple[int, ...]]:
    return list(itertools.combinations(range(blocks), blocks - bits))


def _block_keys(fp: Column, bits: int, blocks: int) -> Column:
    """One long for each choice of blocks: its number, then the bits of its blocks."""
    spans = _block_bits(blocks)
    keys = []
    for number, choice in enumerate(_choices(bits, blocks)):
        key = F.lit(0).cast("bigint")
        for b in choice:
            part = F.shiftrightunsigned(fp, spans[b][0]).bitwiseAND(F.lit((1 << len(spans[b])) - 1))
            key = F.shiftleft(key, len(spans[b])).bitwiseOR(part)
        keys.append(key.bitwiseOR(F.lit(number << KEY_SHIFT)))
    return F.explode(F.array(*keys))


def _forest(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all runs of equal keys: the smallest member and each member it reaches."""
    n = len(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    values, label, waiting = fps.view(np.uint64), np.arange(n), []

    def fold():
        nonlocal label
        i, j = (np.concatenate(x) for x in zip(*waiting))
        label = joined_labels(n, label[i], label[j])[label]
        waiting.clear()

    at, lag, held = np.arange(n), 1, 0
    while len(at := at[end[at] > at + lag]):
        near = at[np.bitwise_count(values[at] ^ values[at + lag]) <= bits]
        near = near[label[near] != label[near + lag]]
        if len(near):
            waiting.append((near, near + lag))
            held += len(near)
        if held > PAIRS_AT_ONCE:
            fold()
            held = 0
        lag += 1
    if waiting:
        fold()
    moved = np.flatnonzero(label != np.arange(n))
    return fps[label[moved]], fps[moved]


def block_links(fps: DataFrame, bits: int = MAX_BITS, blocks: int = BLOCKS, max_run: int = MAX_RUN) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``bits``; fps has distinct values."""
    keyed = fps.select(_block_keys(F.col("fp"), bits, blocks).alias("key"), "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])

    def linked(keys, values):
        a, b = _forest(keys, values, bits)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], schema=schema)

    def unpaired(keys, values):
        return pa.RecordBatch.from_arrays([pa.array(values), pa.nulls(len(values), pa.int64()), pa.array(keys)], schema=schema)

    def task(batches):
        keys = values = np.empty(0, np.int64)
        large = None  # the key of a run that has outgrown max_run
        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy()))
            values = np.concatenate((values, batch.column(1).to_numpy()))
            if large is not None:
                cut = int(np.searchsorted(keys, large, "right"))
                yield unpaired(keys[:cut], values[:cut])
                keys, values = keys[cut:], values[cut:]
                if not len(keys):
                    continue
                large = None
            cut = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
            yield from settled(keys[:cut], values[:cut])
            keys, values = keys[cut:], values[cut:]
            if len(keys) > max_run:
                yield unpaired(keys, values)
                large, keys, values = keys[-1], keys[:0], values[:0]
        yield from settled(keys, values)

    def settled(keys, values):
        if not len(keys):
            return
        _, inverse, size = np.unique(keys, return_inverse=True, return_counts=True)
        over = (size > max_run)[inverse]
        if over.any():
            yield unpaired(keys[over], values[over])
        kept = (size > 1)[inverse] & ~over
        if kept.any():
            yield linked(keys[kept], values[kept])

    found = saved(
        keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(task, "a bigint, b bigint, key bigint"), "simhash-links"
    )
    crowded = _midpoint_links(found.where("key is not null").select("key", F.col("a").alias("fp")), bits, blocks)
    return found.where("key is null").select("a", "b").union(crowded).distinct()


def _midpoint_links(crowded: DataFrame, bits: int, blocks: int) -> DataFrame:
    """Links of large blocks through values that both sides reach by flipping half the bits."""
    if bits % 2:
        raise ValueError("bits must be even")
    spans, choices = _block_bits(blocks), _choices(bits, blocks)
    masks = []
    for choice in choices:
        free = [1 << x for b in range(blocks) if b not in choice for x in spans[b]]
        masks.append(np.array(
            [sum(c) for k in range(bits // 2 + 1) for c in itertools.combinations(free, k)], np.uint64
        ).view(np.int64))

    def task(batches):
        for batch in batches:
            for key, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                middle = np.int64(fp) ^ masks[key >> KEY_SHIFT]
                n = len(middle)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key)), pa.array(middle), pa.array(np.full(n, fp))], ["key", "middle", "fp"]
                )

    # A value has at most one row for each mask, so these groups are bounded whatever the block.
    near = crowded.mapInArrow(task, "key bigint, middle bigint, fp bigint")
    least = F.min("fp").over(Window.partitionBy("key", "middle"))
    return near.select(least.alias("a"), F.col("fp").alias("b")).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(node, root): each linked node with the smallest node it reaches (alternating stars).

    Every round is a written table, so a lost executor costs one round at most.  A node with very
    many neighbours is a minimum that combines before the shuffle and a join that Spark splits.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        edges = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        edges = (
            edges.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = saved(edges, "links")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_groups(
    docs: DataFrame, bits: int = MAX_BITS, blocks: int = BLOCKS, shingle: int = SHINGLE, max_run: int = MAX_RUN
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs."""
    fps = saved(fingerprints(docs, shingle), "fingerprints")
    first = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "first-ids")
    roots = components(block_links(first.select("fp"), bits, blocks, max_run))
    member = roots.select(F.col("node").alias("fp"), "root").union(roots.select("root", "root").distinct())
    lowest = member.join(first, "fp").groupBy("root").agg(F.min("first_id").alias("low_id"))
    named = member.join(lowest, "root").select("fp", "low_id")
    owner = first.join(named, "fp", "left").select("fp", F.coalesce("low_id", "first_id").alias("component_id"))
    return fps.join(owner, "fp").select("doc_id", _hex("fp").alias("fingerprint"), "component_id")
