"""SimHash groups, line, exact and substring dedup against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sqlloom.llm import exact, lines, simhash, substrings
from sqlloom.llm.common import joined_labels

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def slow_fingerprint(text, k=4):
    words = WORDS.findall(lowered(text))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) and hashes)


def slow_components(fps, bits=4):
    """Smallest index reachable, by comparing all pairs."""
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def test_fingerprint_is_the_definition(corpus):
    for _, text in corpus:
        assert simhash.fingerprint((text or "").encode()) & (2**64 - 1) == slow_fingerprint(text)


def check_groups(df, rows):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())
    fps = [slow_fingerprint(t) for _, t in rows]
    roots = slow_components(fps)
    least = defaultdict(list)
    for (doc_id, _), r in zip(rows, roots):
        if doc_id is not None:
            least[r].append(doc_id)
    assert got == Counter((i, f"{fp:016x}", min(least[r], default=None)) for (i, _), fp, r in zip(rows, fps, roots))


def test_groups_by_all_pairs(docs_of, corpus):
    check_groups(simhash.near_groups(docs_of(corpus)), corpus)


@pytest.mark.parametrize("max_run", [1, 3])
def test_large_blocks_find_the_same_links(docs_of, corpus, max_run):
    check_groups(simhash.near_groups(docs_of(corpus), max_run=max_run), corpus)


@pytest.mark.parametrize("max_run", [4096, 20])
def test_links_of_a_dense_cluster(spark, max_run):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 6, dtype=np.uint64)
    fps = set(centre.tolist()) | {int(rng.integers(0, 2**63)) for _ in range(300)}
    for c in centre.tolist():
        for _ in range(60):
            flipped = c
            for b in rng.choice(64, rng.integers(1, 7), replace=False).tolist():
                flipped ^= 1 << b
            fps.add(flipped)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp bigint")
    roots = {r.node % 2**64: r.root for r in simhash.components(simhash.block_links(df, max_run=max_run)).collect()}
    mine = defaultdict(set)
    for f in fps:
        mine[roots.get(f, f if f < 2**63 else f - 2**64)].add(f)
    theirs = defaultdict(set)
    for f, r in zip(fps, slow_components(fps)):
        theirs[r].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_chain_and_a_star(spark):
    links = [(n, n + 1) for n in range(50)] + [(1000, n) for n in range(1001, 1100)] + [(7000, 6999), (6999, 7000), (5, 5)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{n: 0 for n in range(1, 51)}, **{n: 1000 for n in range(1001, 1100)}, 7000: 6999}
    assert simhash.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_joined_labels():
    assert joined_labels(6, np.array([5, 3, 1]), np.array([3, 1, 4])).tolist() == [0, 1, 2, 1, 1, 1]



def slow_lines(rows):
    """Kept texts; rows with the same id and text count as one document."""
    first, repeats = {}, defaultdict(set)
    order = sorted({(i is not None, i or 0, t) for i, t in rows if t is not None})
    # Rows with one id and several texts may come in either order; the fixture has no window that shows it.
    for known, i, text in order:
        at = [n for n, x in enumerate(text.split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
        for k in range(len(at) - 2):
            key = tuple(text.split("\n")[n].strip(" \t\n\x0b\x0c\r") for n in at[k : k + 3])
            if first.setdefault(key, (known, i, text, k)) != (known, i, text, k):
                repeats[known, i, text].update(at[k : k + 3])
    return {(i if known else None, t): "\n".join(x for n, x in enumerate(t.split("\n")) if n not in repeats[known, i, t]) for known, i, t in order}


def test_lines(docs_of, corpus):
    docs = docs_of(corpus)
    expected = slow_lines(corpus)
    kept = lines.dedup_lines(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter((i, None if t is None else expected[i, t]) for i, t in corpus)
    assert sum(t is not None and expected[i, t] != t for i, t in corpus) > 10


def test_exact(docs_of, corpus):
    got = Counter(tuple(r) for r in exact.exact_dedup(docs_of(corpus)).collect())
    groups = defaultdict(list)
    for i, t in corpus:
        groups[lowered(t)].append(i)
    expected = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, keep, len(ids), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert got == expected


def test_index_goes_on_where_it_was(spark, docs_of):
    index = exact.DigestIndex(spark, buckets=4)
    first = exact.digests(docs_of([(1, "a"), (2, "A"), (3, "b")]))
    assert {r.doc_id for r in index.add(first).collect()} == {2, 3}
    again = exact.DigestIndex(spark, index.path, buckets=4)
    second = exact.digests(docs_of([(9, "a"), (10, "c"), (11, "C")]))
    assert [r.doc_id for r in again.add(second).collect()] == [11]
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.decisions(second, again).collect()) == [
        (9, 2, 3, False), (10, 11, 2, False), (11, 11, 2, True)
    ]
    joined = first.groupBy("digest").count().join(again.rows().hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_index_keeps_its_number_of_buckets(spark, docs_of):
    rows = exact.digests(docs_of([f"text {n}" for n in range(2000)]))
    index = exact.DigestIndex(spark, buckets=128)
    assert index.add(rows).count() == 2000
    again = exact.DigestIndex(spark, index.path)
    assert again.buckets == 128 and again.rows().count() == 2000
    assert again.add(rows).count() == 0
    held = again.rows().where("not known").select("digest")
    assert rows.hint("merge").join(held.hint("merge"), "digest").count() == 2000
    with pytest.raises(ValueError, match="128 buckets"):
        exact.DigestIndex(spark, index.path, buckets=64)


def slow_substrings(rows, span=13):
    first = {}
    split = [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - span + 1):
            if i is not None:
                key = tuple(words[k : k + span])
                first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, words in split:
        gone = set()
        for k in range(len(words) - span + 1):
            if i is not None and first[tuple(words[k : k + span])] < i:
                gone.update(range(k, k + span))
        out[i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"max_stretches": 1}, {"span": 4, "gram": 2}, {"span": 1}])
def test_substrings(docs_of, corpus, options):
    got = Counter(tuple(r) for r in substrings.dedup_substrings(docs_of(corpus), **options).collect())
    expected = slow_substrings(corpus, options.get("span", 13))
    assert got == expected
    assert sum(k[2] > 0 for k in expected) > 20


def test_automaton_names_the_first_document():
    automaton = substrings.SuffixAutomaton()
    texts = {7: "a b c a b d", 3: "x a b d", 5: "c a b d c a b", 4: "a a a a", 9: "a b c a b d"}
    for i, t in texts.items():
        automaton.add(t.split(), i)
    automaton.settle()
    for t in [*texts.values(), "q a b c a b d q", "b d c a b", "a"]:
        for span in (1, 2, 3, 4):
            words = t.split()
            expected = []
            for k in range(len(words) - span + 1):
                w = words[k : k + span]
                expected.append(min((i for i, s in texts.items() if any(s.split()[j : j + span] == w for j in range(len(s.split())))), default=None))
            assert automaton.firsts(words, span) == expected


def test_empty_tables(docs_of):
    none = docs_of([(1, "y")]).where("false")
    assert simhash.near_groups(none).count() == 0
    assert lines.dedup_lines(none).count() == 0
    assert exact.exact_dedup(none).count() == 0
    assert substrings.dedup_substrings(none).count() == 0


def test_a_group_with_a_third_of_all_rows(spark):
    texts = F.when(F.col("id") % 3 == 0, F.lit("one hot text\nof three lines\nthat many share and that is long enough to have a window")).otherwise(
        F.concat(F.lit("own text "), F.col("id").cast("string"), F.lit("\nline\nthird"))
    )
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), texts.alias("text"), F.lit("s").alias("source"))
    assert exact.exact_dedup(docs).where("group_size = 1000").count() == 1000
    assert lines.dedup_lines(docs).where("text = ''").count() == 999
    assert substrings.dedup_substrings(docs).where("n_removed = 18").count() == 999
    assert simhash.near_groups(docs).where("component_id = 0").count() >= 1000
