"""Spelling variants against the definition in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from sqlloom.llm import spelling as S

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow_words(rows, least=6, one_in=199):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return found


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(words, ratio=5):
    rows = {}
    for w, n in words.items():
        own = [(-words[v], v) for v in words if near(w, v)]
        form = min(own)[1] if own and -min(own)[0] >= ratio * n else None
        rows[w] = (form, n, len(own), words[form] if form else None)

    def root(w):
        return root(rows[w][0]) if rows[w][0] else w

    return sorted((w, form or "", root(w), n, k, form_n or 0) for w, (form, n, k, form_n) in rows.items())


def invented(seed, n, letters="abé"):
    """Words over few letters, so that many are near each other, with very uneven counts."""
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 9))) for _ in range(n)]
    return {w: 5 * rng.choice([1, 1, 1, 6, 40, 300]) for w in words}


def check(df, words):
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())
    assert got == slow_variants(words)


def pairs_of(spark, words, **options):
    df = spark.createDataFrame(sorted(words.items()), "word string, n bigint")
    return sorted((r.word, r.near, r.near_n) for r in S.near_pairs(df, **options).collect())


@pytest.mark.parametrize("at_once", [1 << 16, 40, 3])
def test_all_near_pairs_in_blocks_of_any_size(spark, at_once):
    words = invented(4, 400)
    expected = sorted((a, b, words[b]) for a in words for b in words if near(a, b))
    assert len(expected) > 300
    assert pairs_of(spark, words, at_once=at_once) == expected


def test_a_third_of_all_words_shares_a_half(spark):
    words = invented(5, 200) | {"abcabc" + a + b + c: 7 for a in "abcdefg" for b in "abcdefg" for c in "hij"}
    expected = sorted((a, b, words[b]) for a in words for b in words if near(a, b))
    assert pairs_of(spark, words, at_once=20) == expected


def test_index_ranks_and_intervals():
    words = sorted(invented(6, 60))
    index = S.WordIndex(words)
    text = "$" + "$".join(words) + "$"
    for pattern in ("a", "ab", "$a", "ba$", "abb", "éa", words[3], "$" + words[3] + "$"):
        for start in range(len(pattern)):
            # Out from one letter, to the right and then to the left.
            states = index.whole(1)
            for c in pattern[start:]:
                states = index.extend(states, S.np.array([1 if c == "$" else index.code[c]]), False)
            for c in reversed(pattern[:start]):
                states = index.extend(states, S.np.array([1 if c == "$" else index.code[c]]), True)
            assert states[2][0] == sum(text.startswith(pattern, k) for k in range(len(text)))
    assert index.extend(states, S.np.array([1]), True)[2][0] == 0
    assert states[0][0] - index.first == 3


def test_documents_with_odd_texts(spark, docs_of, corpus):
    rows = [(d, t) for d, t in corpus] * 2
    rows += [(n, " ".join(["Überraschung", "überraschung", "uberraschung", "ÜBERRASCHUNG×", "straße÷", "ZWEIFEL", "zweifel"] * 6)) for n in range(300, 500)]
    rows += [(None, "nameless nameless nameles " * 9), (None, None), (7, "z" * 20000 + " ")] + [(8, "q" * 200)] * 6
    words = {w: n for w, n in slow_words(rows).items() if n >= 5}
    assert "q" * 200 in words and any("ber" in w for w in words)
    check(S.variants(docs_of(rows)), words)
    check(S.variants(docs_of(rows), at_once=4), words)


def test_chains_of_forms_lead_to_one_root(spark, docs_of):
    counts = {"aaaaaaaa": 5, "aaaaaaab": 25, "aaaaaabb": 125, "aaaaabbb": 625, "aaaabbbb": 3125, "cccccccc": 30, "ccccccccc": 5, "cccccccd": 30}
    rows = [(n, " ".join([w] * k)) for n, (w, k) in enumerate(counts.items())]
    words = {w: n for w, n in slow_words(rows, one_in=1 << 40).items() if n >= 5}
    df = S.variants(docs_of(rows), one_in=1 << 40)
    check(df, words)
    assert {r.root for r in df.collect() if r.word.startswith("a")} == {"aaaabbbb"}


def test_no_words(docs_of):
    assert S.variants(docs_of([None, "", "short one", "日本語 " * 9])).count() == 0
    assert S.variants(docs_of(["x"]).where("false")).count() == 0


def test_a_deletion_is_not_deleted_again(spark):
    rng = random.Random(9)
    for _ in range(300):
        text = " ".join("".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(200))
        doc_id = rng.randrange(10**6)
        got = S.words_of(doc_id, text.encode(), one_in=3)
        assert Counter({w.decode(): n for w, n in got.items()}) == slow_words([(doc_id, text)], one_in=3)
