"""Token ids, record files, packing, mixing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sqlloom.llm import mixing, packing, records
from sqlloom.llm.encoding import Encoder
from sqlloom.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, tokenizer_path

FILES = [WORD_TOKENIZER, BYTE_TOKENIZER]
ENCODERS = {}


def encoder(name):
    if name not in ENCODERS:
        ENCODERS[name] = Encoder(tokenizer_path(name))
    return ENCODERS[name]


def plain_ids(name, text):
    """By a tokenizer of its own, loaded from the file and left as it is."""
    if (name, "plain") not in ENCODERS:
        ENCODERS[name, "plain"] = Tokenizer.from_file(tokenizer_path(name))
    return ENCODERS[name, "plain"].encode(text or "", add_special_tokens=False).ids


def ids_of(name, text):
    e = encoder(name)
    return np.frombuffer(e(text), e.dtype).tolist()


@pytest.mark.parametrize("name", FILES)
def test_ids_are_the_library_s(corpus, name):
    assert encoder(name).layout
    for _, text in corpus:
        for _ in range(2):  # the second time from memory
            assert ids_of(name, text or "") == plain_ids(name, text)


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("ab AB'\n\t.,!09éÉß́  İſ日🙂sTre<|>"), max_size=40))
def test_ids_of_any_text(name, text):
    assert ids_of(name, text) == plain_ids(name, text)


@pytest.mark.parametrize("name", FILES)
def test_strings_of_added_tokens(name):
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|endoftext|", "<|ENDOFTEXT|> z", "<| endoftext |> w", "a\n<|endoftext|><|endoftext|> c"):
        for _ in range(2):
            assert ids_of(name, text) == plain_ids(name, text)
    assert len(ids_of(name, "a <|endoftext|> b")) == {WORD_TOKENIZER: 3, BYTE_TOKENIZER: 4}[name]


@pytest.mark.parametrize("name", FILES)
def test_a_small_memory_forgets_and_stays_right(name):
    small, rng = Encoder(tokenizer_path(name), memo=50), random.Random(4)
    for _ in range(60):
        text = " ".join(rng.choice(["red", "Red,", "blue", "it's", "(a", "b)", f"w{rng.randrange(80)}"]) for _ in range(40))
        assert np.frombuffer(small(text), small.dtype).tolist() == plain_ids(name, text)


def test_records_round_trip(spark, docs_of, corpus, tmp_path):
    path = str(tmp_path / "records")
    index = records.tokenized(docs_of(corpus), tokenizer_path(WORD_TOKENIZER), path).cache()
    rows = index.orderBy("shard", "offset").collect()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert Counter(ids) == Counter(i for i, _ in corpus)
    expected = defaultdict(list)
    for i, t in corpus:
        tokens = plain_ids(WORD_TOKENIZER, t) + [1]
        expected[i].append((len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
    start = 0
    for r in rows:
        assert (r.n_tokens, r.ids_crc32) in expected[r.doc_id] and r.start == start
        start += r.n_tokens
    read = {r.doc_id: r.ids for r in records.read_records(spark, path, index.where("doc_id between 10 and 30"), seed=3).collect()}
    assert read == {i: plain_ids(WORD_TOKENIZER, t) + [1] for i, t in corpus if i is not None and 10 <= i <= 30}


def test_broken_records_are_found():
    good = records.frame(5, b"\1\0\2\0", 2)
    doc_id, ids, end = records.unframe(memoryview(good), 0)
    assert (doc_id, ids.tolist(), end) == (5, [1, 2], len(good))
    for at in range(len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(bytes(bad)), 0)


def slow_best_fit(lengths, capacity):
    """Bins that best-fit decreasing opens, item by item."""
    remaining = []
    for x in sorted(lengths, reverse=True):
        fits = [(r, n) for n, r in enumerate(remaining) if r >= x]
        if fits:
            remaining[min(fits)[1]] -= x
        else:
            remaining.append(capacity - x)
    return len(remaining)


def laid_out(plan, capacity):
    """Bins of a plan, after checking that they hold their pieces without gaps."""
    bins = defaultdict(list)
    for length, _, count, first, offset in plan.tolist():
        for k in range(count):
            bins[first + k].append((offset, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 31, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(1, 400))]
    plan = packing.packing_plan(Counter(lengths), capacity)
    bins = laid_out(plan, capacity)
    assert Counter(length for parts in bins.values() for _, length in parts) == Counter(lengths)
    assert len(bins) == slow_best_fit(lengths, capacity)
    ranks = defaultdict(int)
    for length, rank, count, _, _ in plan.tolist():
        assert rank == ranks[length]
        ranks[length] += count


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.lists(st.integers(0, 40)), st.integers(0, 40))
def test_tightest(capacity, bins, length):
    tree = packing.CapacityTree(capacity)
    bins = [b for b in bins if b <= capacity]
    for b in bins:
        tree.change(b, 1)
    length = min(length, capacity)
    assert tree.tightest(length) == min((b for b in bins if b >= length), default=None)


def test_piece_spans():
    assert packing.piece_spans(5, 5) == [(0, 5)]
    assert packing.piece_spans(3, 5) == [(0, 3)]
    assert packing.piece_spans(12, 5) == [(0, 2), (2, 5), (7, 5)]
    assert packing.piece_spans(10, 5) == [(0, 5), (5, 5)]


@pytest.mark.parametrize("capacity", [2048, 50])
def test_packing(docs_of, corpus, capacity):
    rows = packing.pack(docs_of(corpus), tokenizer_path(BYTE_TOKENIZER), capacity=capacity).collect()
    expected, lengths = Counter(), []
    for i, t in corpus:
        tokens = np.array(plain_ids(BYTE_TOKENIZER, t) + [0], "<u4")
        for n, (start, length) in enumerate(packing.piece_spans(len(tokens), capacity)):
            expected[i, n, start, length, zlib.crc32(tokens[start : start + length].tobytes())] += 1
            lengths.append(length)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist()
        assert sum(n for _, n in parts) <= capacity
    assert len(bins) == slow_best_fit(lengths, capacity)


def test_sequences_hold_the_ids(docs_of):
    texts = [" ".join(["word"] * n) for n in range(1, 30)]
    path = tokenizer_path(BYTE_TOKENIZER)
    cut = packing.saved(packing.pieces(docs_of(texts), path, capacity=64), "pieces")
    places = packing.place(cut, 64)
    got = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(cut, places).collect()}
    for p in places.collect():
        tokens = plain_ids(BYTE_TOKENIZER, texts[p.doc_id]) + [0]
        assert got[p.sequence_id][p.offset : p.offset + p.length] == tokens[p.start : p.start + p.length]


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Excess over the caps shared again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    full, rest = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        given_ = {s: rest * weight[s] / total for s in open_} if total else {}
        over = [s for s in open_ if given_[s] > most * sizes[s]]
        if not over:
            return {**full, **given_}
        for s in over:
            full[s] = most * sizes[s]
            rest -= full[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{n}": rng.choice([0, 1, 10, 1000, 50_000]) + rng.randrange(20) for n in range(rng.randrange(1, 12))}
    sizes[None] = rng.randrange(500)
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(slow_targets(sizes))


def test_mix(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 50 != 0, F.expr("concat_ws(' ', array_repeat('w', cast(id % 17 as int)))")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 != 0, F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"),
        F.lit(1).alias("epochs"),
    )
    rows = mixing.plan(docs).collect()
    taken, target, size = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r.epochs <= 2
        taken[r.source] += r.epochs * r["size"]
        size[r.source] += r["size"]
        target[r.source] = r.target
    assert target == pytest.approx(slow_targets(size))
    assert all(abs(taken[s] - target[s]) <= 17 for s in target)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.epochs for r in rows if r.epochs})
    assert mixing.plan(docs).exceptAll(mixing.plan(docs.repartition(7))).count() == 0


def test_mix_of_repeated_rows(docs_of, corpus):
    docs = docs_of(corpus)
    rows = mixing.plan(docs).collect()
    assert len(rows) == len(corpus)
    assert mixing.mix(docs).count() == sum(r.epochs for r in rows)


def test_empty_tables(spark, docs_of, tmp_path):
    none = docs_of([(1, "y")]).where("false")
    assert packing.pack(none, tokenizer_path(BYTE_TOKENIZER)).count() == 0
    assert records.tokenized(none, tokenizer_path(WORD_TOKENIZER), str(tmp_path / "none")).count() == 0
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0
    assert packing.packing_plan({}).shape == (0, 5)
