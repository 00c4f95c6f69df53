import hashlib
import random
import re

import pytest

from tidemark.llm import ngram_join

BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def grams(text, size):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in BLANKS.split(lower) if w]
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    """Smallest id of the component of every row."""
    sets = [grams(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and both:
                parent[root(i)] = root(j)
    least = {}
    for i, (id, _) in enumerate(rows):
        if id is not None:
            least[root(i)] = min(least.get(root(i), id), id)
    out = []
    for i, (id, _) in enumerate(rows):
        out.append((id, len(sets[i]), least.get(root(i)) if sets[i] else id))
    return sorted(out, key=str)


def near_copies(seed, families=12, members=18):
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(30)]
    for f in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, members)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                copy += passage
            if rng.random() < 0.2:
                copy = [w.upper() for w in copy]
            rows.append((rng.randrange(10**6), " ".join(copy)))
    return rows


@pytest.mark.parametrize(("size", "percent", "block"), [(4, 85, 256), (2, 60, 3)])
def test_against_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "WIDE", 5)
    monkeypatch.setattr(ngram_join, "LANE", 3)
    monkeypatch.setattr(ngram_join, "GUESTS", 2)
    rows = near_copies(size)
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=size, percent=percent)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert got == brute(rows, size, percent)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = ngram_join.near_duplicates(odd).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, 5, 80)


def test_documents_that_stay(odd):
    kept = ngram_join.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    want = {c if c is not None else i for i, n, c in brute([(r.doc_id, r.text) for r in odd.collect()], 5, 80) if n or i is not None}
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == len(set(got))
    assert {i for i in got if i is not None} == {i for i in want if i is not None}


def brute_kept(rows, size, percent):
    """(id, text) of the rows that stay: all without words, and one of each component."""
    sets = [grams(t, size) for _, t in rows]
    out = [r for r, s in zip(rows, sets) if not s]
    left = [i for i, s in enumerate(sets) if s]
    while left:
        part, open_ = set(), [left[0]]
        while open_:
            i = open_.pop()
            if i in part:
                continue
            part.add(i)
            for j in left:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    open_.append(j)
        best = min(part, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, -len(rows[i][1]), hashlib.md5(rows[i][1].encode()).hexdigest()))
        out.append(rows[best])
        left = [i for i in left if i not in part]
    return sorted(out, key=str)


def test_kept_with_null_and_repeated_ids(spark):
    rng, rows = random.Random(3), []
    # A third of the near copies have no id, another third share few ids.
    for id, text in near_copies(8, families=10, members=8):
        rows.append((rng.choice([None, rng.randrange(6), id]), text))
    rows += [(None, "no relation to any other text"), (None, "nor has this one any relation"), (None, None), (None, " \t"), (None, "")]
    rows += [(700, "one unique text under a repeated id"), (700, "quite another and longer unique text under the same repeated id")]
    # The longer text of id 800 is the near copy of id 1; the shorter one is like nothing else.
    copy = " ".join(f"c{i}" for i in range(40))
    rows += [(-1, copy), (800, copy + " more"), (800, "short and unique"), (800, ""), (800, None), (900, copy + " more"), (900, copy + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in ngram_join.drop_near_duplicates(docs).collect()]
    assert sorted(got, key=str) == brute_kept(rows, 5, 80)


def test_kept_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [(r.doc_id, r.text) for r in ngram_join.drop_near_duplicates(odd).collect()]
    assert sorted(got, key=str) == brute_kept(rows, 5, 80)


def test_empty_table(nothing):
    assert ngram_join.near_duplicates(nothing).count() == 0
    assert ngram_join.drop_near_duplicates(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(1, 60)] + [(1000, 2000), (5, 5)], "u long, v long")
    roots = {r.node: r.root for r in ngram_join.components(links).collect()}
    assert roots == {**{i: 1 for i in range(2, 61)}, 2000: 1000} or {k: v for k, v in roots.items() if k != v} == {
        **{i: 1 for i in range(2, 61)},
        2000: 1000,
    }
