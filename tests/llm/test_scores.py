"""Toxicity, quality rules, language-model scores and the pipeline."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sqlloom.llm import jaccard, ppm, quality, queries, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.01"


def test_ordinal_fit_keeps_order_and_learns():
    rng = np.random.default_rng(1)
    n, words = 600, 12
    x = rng.integers(0, 2, (n, words)).astype(float)
    true = np.concatenate(([2.5, -2.0], np.zeros(words - 2)))
    noise = rng.logistic(size=n) * 0.1  # at 0.3 the best guess is wrong in one of six
    latent = x @ true + noise
    grades = (latent > 0.2).astype(int) + (latent > 1.5)
    rows, cols = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(rows, cols, x[rows, cols], grades, words)
    assert np.all(np.diff(thresholds) > 0) and weights[0] > 1 > -1 > weights[1]
    model = toxicity.Model({}, weights, thresholds)
    severity = model.severity(x @ weights)
    assert np.mean(np.abs(np.rint(severity) - grades)) < 0.15
    # The expected grade is the sum of grades by their chances.
    below = 1 / (1 + np.exp(-(np.concatenate((thresholds, [50.0]))[None, :] - (x @ weights)[:, None])))
    chances = np.diff(np.concatenate((np.zeros((n, 1)), below), axis=1), axis=1)
    assert np.allclose(severity, chances @ np.arange(3), atol=1e-6)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    assert len(model.thresholds) == 2
    pairs = toxicity.scored(docs, model).withColumnRenamed("toxic", "found").join(labels.where(held_out), "doc_id")
    counts = Counter((r.toxic, r.found) for r in pairs.collect())
    assert sum(counts.values()) > 200
    assert counts[0, True] <= 0.01 * (counts[0, True] + counts[0, False])
    assert counts[1, True] >= 0.8 * (counts[1, True] + counts[1, False])


def slow_severity(model, text):
    """Expected grade of one text, feature by feature."""
    folded = re.sub(r"[!-/:-@\[-`{-~]", " ", lowered(text)).encode()
    logit, counts = 0.0, Counter(folded.split())
    for feature, k in model.words.items():
        if feature.endswith(b"-"):
            n = sum(c for w, c in counts.items() if len(w) > len(feature) - 1 and w.startswith(feature[:-1]))
        else:
            n = counts[feature]
        if n:
            logit += model.weights[k] * (1 + math.log(n))
    return sum(1 / (1 + math.exp(t - logit)) for t in model.thresholds)


def test_severity_by_plain_arithmetic(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    assert len(model.words) > 100 and len(model.thresholds) >= 1
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == len(texts) and all(r.severity == pytest.approx(slow_severity(model, texts[r.doc_id]), rel=1e-9) for r in rows)


def test_fit_is_a_minimum():
    """No small step from the fitted weights and thresholds lowers the penalised mean loss by much."""
    rng = np.random.default_rng(2)
    n, words = 300, 6
    x = rng.poisson(0.7, (n, words)).astype(float)
    grades = np.digitize(x @ np.array([1.5, -1, 0.5, 0, 0, 2]) + rng.logistic(size=n), [1, 3])
    rows, cols = np.nonzero(x)
    weights, cuts = toxicity.fit_ordinal(rows, cols, x[rows, cols], grades, words)

    def loss(w, t):
        below = np.hstack((np.zeros((n, 1)), 1 / (1 + np.exp((x @ w)[:, None] - t[None, :])), np.ones((n, 1))))
        return -np.log(below[np.arange(n), grades + 1] - below[np.arange(n), grades]).mean() + toxicity.RIDGE / 2 * (w**2).sum()

    best = loss(weights, cuts)
    for k in range(words):
        for step in (-0.05, 0.05):
            assert loss(weights + step * (np.arange(words) == k), cuts) > best - 1e-3
    for k in range(len(cuts)):
        for step in (-0.05, 0.05):
            assert loss(weights, cuts + step * (np.arange(len(cuts)) == k)) > best - 1e-3


def test_toxicity_cases(spark, docs_of, corpus):
    docs = docs_of(corpus)
    labels = spark.createDataFrame([(n, int(n % 2)) for n in range(60)] + [(None, 1), (7, None), (9999, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs, model).collect()
    assert len(rows) == len(corpus) and all(0 <= r.severity <= len(model.thresholds) for r in rows)
    kept = toxicity.remove_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not r.toxic for r in rows)
    nothing = toxicity.fit(docs, labels.where("false"))
    assert {(r.severity, r.toxic) for r in toxicity.scored(docs, nothing).collect()} == {(0.0, False)}
    assert toxicity.remove_toxic(docs.where("false"), nothing).count() == 0
    graded = toxicity.fit(docs, labels.withColumn("toxic", F.col("doc_id") % 4), graded=True)
    assert len(graded.thresholds) == 3


def slow_quality(text):
    words = WORDS.findall(text or "")
    covered = set()
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    for k in range(len(words) - 4):
        if windows[tuple(words[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    seen = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(words), len("".join(words)), sum(c in "#*$%&|<>" for c in text or ""), len(seen) - len(set(seen)), len(covered)


def test_quality(docs_of, corpus):
    docs = docs_of(corpus)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judged(docs).collect())
    assert got == Counter((i, *slow_quality(t)) for i, t in corpus)
    kept = quality.clean(docs)
    assert kept.columns == docs.columns and kept.count() == quality.judged(docs).where("kept").count()
    assert quality.judged(docs.where("false")).count() == 0


@pytest.mark.parametrize(("line", "fails"), [
    ("", False), ("   ", False), ("Home", True), ("Three word line.", False), ("Home | About | Contact us | Jobs", True),
    ("A line of many words without a mark at its end", False), ("Please accept our Cookie Policy to go on now.", True),
    ("BUY!! NOW!! THE!! BEST!! OFFER!!", True), ("Nothing to see here, move on please!", False),
    ("The cookie policy " + "was read and read more than once by all " * 3, False),
])
def test_line_rules(line, fails):
    assert quality.line_fails(line, WORDS.findall(line)) is fails


def test_labels_agree_with_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    counts = Counter((r.quality, r.kept) for r in quality.judged(docs).join(labels, "doc_id").collect())
    assert counts[1, True] >= 0.9 * (counts[1, True] + counts[1, False])


def slow_chances(counts, context) -> list[float]:
    """Chance of every byte after a context, by walking down the orders."""
    if context is None:
        return [1 / 256] * 256
    own, shorter = counts.get(context, {}), slow_chances(counts, context[1:] if context else None)
    if not own:
        return shorter
    n, u = sum(own.values()), len(own)
    left = sum(shorter[b] for b in range(256) if b not in own)
    escape = u / (2 * n)
    return [(2 * own[b] - 1) / (2 * n) if b in own else escape * shorter[b] / left for b in range(256)]


def test_byte_model_by_walking_the_trie():
    texts = [b"abracadabra abra", b"cab a bra", b"", b"abac", bytes(range(97, 123)) * 3]
    counts = {}
    for t in texts:
        data = ppm._padded(t)
        for k in range(ppm.ORDER, len(data)):
            for order in range(ppm.ORDER + 1):
                counts.setdefault(data[k - order : k], Counter())[data[k]] += 1
    orders = []
    for order in range(ppm.ORDER + 1):
        grams = {int.from_bytes(c + bytes([b]), "big"): n for c, own in counts.items() if len(c) == order for b, n in own.items()}
        orders.append((np.array(list(grams)), np.array(list(grams.values()), float)))
    model = ppm.ByteModel(orders)
    tried = [b"abra", b"", b"brac", b"cab a", b"bbbb", b"xyz", b"q" * 40, "né".encode()]
    for t, got in zip(tried, model.log10(tried)):
        data = ppm._padded(t)
        expected = sum(math.log10(slow_chances(counts, data[k - ppm.ORDER : k])[data[k]]) for k in range(ppm.ORDER, len(data)))
        assert got == pytest.approx(expected, rel=1e-4)
    # Chances after a context add up to one.
    for context in (b"abrac", b"zzzzz", b"\xff" * 5, b" a br"):
        keys = int.from_bytes(context, "big") << 8 | np.arange(256)
        assert (10.0 ** model.chances(keys.astype(np.uint64))).sum() == pytest.approx(1, abs=1e-4)


def test_long_texts_are_scored_in_pieces(monkeypatch):
    model = ppm.ByteModel([(np.array([97, 98]), np.array([3.0, 1.0])), (np.array([97 << 8 | 98]), np.array([2.0]))])
    texts = [b"ab" * 50, b"", b"b" * 7, b"abba" * 30]
    whole = model.log10(texts)
    monkeypatch.setattr(ppm, "SCORED_AT_ONCE", 9)
    assert model.log10(texts) == pytest.approx(whole) and len(whole) == 4


def test_hash_table():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 5000).astype(np.uint64))
    table = ppm.HashTable(keys, np.arange(len(keys), dtype=np.float32))
    known, values = table.get(keys)
    assert known.all() and (values == np.arange(len(keys))).all()
    assert not table.get(keys + np.uint64(1))[0][~np.isin(keys + np.uint64(1), keys)].any()
    assert not ppm.HashTable(keys[:0], np.zeros(0)).get(keys)[0].any()


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_token_hashes_tell_tokens_apart():
    rng = random.Random(1)
    texts = [b"", b" ", b"a", b"\n\na b\x0bc ", b"x" * 65 + b" " + b"x" * 64 + b" y" * 3, "日本語 é \x1c z\x85q\x00 a\x00 a".encode()]
    for _ in range(200):
        parts = [b" ", b"\t", b"  ", b"ab", b"w%d" % rng.randrange(999), b"q" * rng.randrange(1, 90)]
        texts.append(b"".join(rng.choices(parts, k=rng.randrange(60))))
    hashes, sizes = ppm._token_hashes(texts)
    named, at = {}, 0
    for text, n in zip(texts, sizes.tolist()):
        tokens = [*text.split(), None]
        assert len(tokens) == n
        for token, h in zip(tokens, hashes[at : at + n].tolist()):
            assert named.setdefault(token, h) == h
        at += n
    assert at == len(hashes) and len(set(named.values())) == len(named)


@pytest.mark.parametrize("block_bytes", [ppm.BLOCK_BYTES, 300])
def test_scores(docs_of, corpus, block_bytes, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block_bytes)
    rows = ppm.scores(docs_of(corpus)).collect()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in corpus}
    tokens = [(i, WORDS.findall(lowered(t)) + ["\n"]) for i, t in corpus]
    counts = Counter(w for i, words in tokens if not held[i] for w in words)
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for i, words in tokens:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        expected[i, held[i], len(words), sum(counts[w] > 0 for w in words), total, round(base, 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_grams_of_all_training_texts(docs_of, corpus):
    docs = docs_of(corpus)
    got = {r.gram: r.n for r in ppm.gram_counts(ppm.blocks_of(docs)).collect()}
    expected = Counter()
    for i, t in corpus:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            data = ppm._padded(lowered(t).encode())
            for k in range(ppm.ORDER, len(data)):
                expected[int.from_bytes(data[k - ppm.ORDER : k + 1], "big")] += 1
    assert got == expected


@pytest.mark.parametrize("heavy", [ppm.HEAVY, 3])
@pytest.mark.parametrize("at_once", [ppm.GRAMS_AT_ONCE, 50])
def test_scores_hold_all_contexts(docs_of, at_once, heavy, monkeypatch):
    monkeypatch.setattr(ppm, "HEAVY", heavy)
    monkeypatch.setattr(ppm, "GRAMS_AT_ONCE", at_once)
    monkeypatch.setattr(ppm, "BLOCK_BYTES", 20_000)
    rng = np.random.default_rng(8)
    count = 170 if at_once > 50 else 20
    texts = ["".join(map(chr, rng.integers(97, 123, 600))) for _ in range(count)] + ["", "abc abc"]
    docs = docs_of(texts)
    grams = {r.gram: r.n for r in ppm.gram_counts(ppm.blocks_of(docs)).collect()}
    assert at_once == 50 or len({g >> 8 for g in grams}) > 1 << 16
    orders = []
    for order in range(ppm.ORDER + 1):
        own = Counter()
        for g, n in grams.items():
            own[g & (1 << 8 * (order + 1)) - 1] += n
        orders.append((np.array(list(own)), np.array(list(own.values()), float)))
    expected = ppm.ByteModel(orders).log10([t.encode() for t in texts])
    got = {r.doc_id: r.score for r in ppm.scores(docs).collect()}
    assert [got[n] for n in range(len(texts))] == pytest.approx(expected.tolist(), rel=1e-5)


def test_scores_of_real_texts(spark):
    # On a thousand documents the unigram is still ahead.
    rows = ppm.scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_scores_without_rows_or_training(docs_of):
    assert ppm.scores(docs_of([(1, "y")]).where("false")).count() == 0
    alone = next(n for n in range(100) if zlib.crc32(str(n).encode()) % 5 == 1)
    row = ppm.scores(docs_of([(alone, "some text")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, pytest.approx(0))
    assert row.score == pytest.approx(10 * math.log10(1 / 256), rel=1e-3)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    tables, now = [docs], docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_DIR)
        now = corpus_pipeline.written(now, corpus_pipeline.run_folder(spark, f"test-{name}"))
        tables.append(now)
        if name != "packing":
            assert now.columns == docs.columns
    _, civil, lines_, apart, mixed, packed = tables
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert civil.join(labels.where("toxic = 1"), "doc_id").count() <= 0.2 * labels.where("toxic = 1").count()
    assert lines_.count() == civil.count()
    # Against the exact join: the first of every group stays, hardly anything else of a group does, all other documents stay.
    groups = {r.doc_id: r for r in jaccard.similarity_groups(lines_).collect()}
    stay, firsts = {r.doc_id for r in apart.collect()}, {r.component_id for r in groups.values() if r.n_shingles}
    wordless = {i for i, r in groups.items() if not r.n_shingles}
    assert firsts <= stay and len(stay & wordless) == min(1, len(wordless))
    assert len(stay - firsts - wordless) <= 0.02 * (len(groups) - len(firsts))
    assert set(r.doc_id for r in mixed.collect()) <= set(r.doc_id for r in apart.collect())
    assert packed.where("piece = 0").count() == mixed.count()
    again = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert again.select(key).exceptAll(packed.select(key)).count() == 0 == packed.select(key).exceptAll(again.select(key)).count()


def test_pipeline_of_odd_rows(spark, docs_of, corpus, tmp_path):
    import corpus_pipeline

    labels = spark.createDataFrame([(n, int(n % 9 == 0)) for n in range(40)], "doc_id bigint, toxic int")
    for name, df in (("odd", docs_of(corpus)), ("empty", docs_of(corpus).where("false"))):
        folder = str(tmp_path / name)
        df.write.parquet(f"{folder}/documents.parquet")
        labels.write.parquet(f"{folder}/labels.parquet")
        assert (corpus_pipeline.run(spark, folder).count() > 50) == (name == "odd")


def test_registered():
    import __spark_entry__ as entry

    names = [f"op{n}_" for n in range(1, 14)]
    assert sorted(n.split("_")[0] + "_" for n in queries.QUERIES) == sorted(names)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_against_sql(spark, name):
    from suite.compare import _rows, duck

    df = queries.QUERIES[name](spark, SF_DIR)
    result = duck(SF_DIR).execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())
