"""The similarity join against all pairs in plain Python."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from sqlloom.llm import jaccard as J
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def slow_groups(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            label[b] = a
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(n)] = min(doc_id, least.get(root(n), doc_id))
    return Counter((d, len(s), least.get(root(n)) if s else d) for n, ((d, _), s) in enumerate(zip(rows, sets)))


def check(df, rows):
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()) == slow_groups(rows)


def variants(seed, bases, each, length=(20, 160), rate=0.06):
    """Texts of a few bases with words replaced, most of them about the limit."""
    rng, rows = random.Random(seed), []
    for b in range(bases):
        base = prose(seed * 1000 + b, rng.randrange(*length), 100_000)
        for _ in range(each):
            own = list(base)
            for at in range(len(own)):
                if rng.random() < rng.uniform(0, rate):
                    own[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_about_the_limit(docs_of, seed):
    rows = variants(seed, 12, 12)
    groups = slow_groups(rows)
    assert 20 < len({c for _, _, c in groups}) < len(rows) - 20
    check(J.similarity_groups(docs_of(rows)), rows)


@pytest.mark.parametrize("tokens_at_once,pivots", [(500, 4), (300, 1), (2000, 64)])
def test_families_in_many_blocks(docs_of, tokens_at_once, pivots):
    rows = variants(3, 2, 70, (60, 90), 0.04)
    check(J.similarity_groups(docs_of(rows), tokens_at_once=tokens_at_once, pivots=pivots), rows)


def test_frequent_tokens_and_a_third_of_all_rows_alike(docs_of):
    shared = " ".join(prose(7, 60))
    rows = [(n, shared + " " + " ".join(prose(n + 50, 20 + n % 30))) for n in range(60)]
    rows += [(100 + n, rows[0][1]) for n in range(40)] + [(200 + n, rows[0][1] + f" tail{n}") for n in range(30)] + [(None, rows[0][1])] * 20
    check(J.similarity_groups(docs_of(rows), sample_texts=40, frequent=3), rows)
    check(J.similarity_groups(docs_of(rows), sample_texts=40, frequent=3, tokens_at_once=400, pivots=2), rows)


def test_odd_texts(docs_of, corpus):
    check(J.similarity_groups(docs_of(corpus)), corpus)


def test_short_texts_and_ties(docs_of):
    rows = [(n, " ".join("abcdefgh"[: n % 9])) for n in range(30)] + [(40, "a b c d e f g h i"), (41, "A B C D E F G H"), (None, ""), (None, None), (42, "\t\n")]
    check(J.similarity_groups(docs_of(rows)), rows)


def test_empty_tables(docs_of):
    assert J.similarity_groups(docs_of(["x"]).where("false")).count() == 0
    assert [tuple(r) for r in J.similarity_groups(docs_of([None])).collect()] == [(0, 0, 0)]


def test_search_is_the_overlap_condition():
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 400)
    sets = []
    for _ in range(200):
        own = base[rng.random(400) < rng.uniform(0.6, 1)]
        sets.append(np.unique(np.concatenate((own, rng.integers(-(2**62), 2**62, rng.integers(0, 60))))))
    index = J.ListIndex(sets)
    links = 0
    for n, s in enumerate(sets):
        expected = [k for k, t in enumerate(sets) if 100 * (b := len(np.intersect1d(s, t))) >= 80 * (len(s) + len(t) - b)]
        assert index.search(s).tolist() == expected
        assert index.search(s, n).tolist() == [k for k in expected if k < n]
        links += len(expected) - 1
    assert links > 200
