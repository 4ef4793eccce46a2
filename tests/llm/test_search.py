"""Decontamination, nearest neighbours and the Jaccard join against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidesift.llm import components as components_, decontaminate as dec, jaccard_tree, nearest
from tidesift.llm.queries import leaks
from tidesift.sources.scratch import stage

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def _prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_retrieval_equals_bm25_by_hand(spark, rows):
    """All parts at or above the threshold in any window, with the scores of plain BM25."""
    rng = random.Random(3)
    items = [(i, _prose(rng, rng.randint(9, 60))) for i in range(40)]
    rule = dec.Rule(score=0.25, overlap=0.0)
    (index,) = dec.indexes(rows(items, "item_id long, text string"), "item_id", "text", None, rule)
    texts = [_prose(rng, n) + " " + " ".join(items[n % 40][1].split()[: n // 5]) + " " + _prose(rng, n) for n in (0, 5, 64, 65, 130, 300, 900)] + [""]
    hashes, counts = dec.plain_words(pa.array(texts))
    found = {}
    for r, p, s, *_ in zip(*dec.retrieve(index, hashes, counts, rule), strict=True):
        found[r, index.items[p]] = max(s, found.get((r, index.items[p]), 0))
    split = {i: t.split() for i, t in items}
    mean = sum(map(len, split.values())) / len(split)
    df = {w: sum(w in x for x in split.values()) for w in WORDS}
    want = {}
    for r, text in enumerate(texts):
        x = text.split()
        windows = max(1, -(-len(x) // dec.STRIDE) - 1)
        for k in range(windows):
            seen = set(x[k * dec.STRIDE : None if k == windows - 1 else (k + 2) * dec.STRIDE])
            for i, own in split.items():
                def weight(w):
                    tf = own.count(w)
                    return math.log1p((len(split) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean))
                score = sum(weight(w) for w in set(own) & seen) / sum(weight(w) for w in set(own))
                if score >= rule.score:
                    want[r, i] = max(score, want.get((r, i), 0))
    assert found.keys() == want.keys() and len(want) > 50
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_leaks_and_clean_rows(rows):
    rng = random.Random(5)
    items = [(i, _prose(rng, 20) + ". " + _prose(rng, 6) + ".") for i in range(30)]
    items += [(100, None), (101, ""), (102, "too short"), (103, _prose(rng, 400)), (None, _prose(rng, 30)), (0, items[0][1])]
    long = items[33][1]
    docs = [
        (1, _prose(rng, 300) + " " + items[3][1].upper() + " " + _prose(rng, 300), "a"), (2, _prose(rng, 500), "b"), (3, None, None),
        (4, "", ""), (5, _prose(rng, 50) + " " + long + " " + items[0][1], "c"), (5, _prose(rng, 9) + items[34][1], "d"),
        (6, items[4][1].split(".")[0], "question only"), (7, "too short", "e"),
    ]
    table = dec.split_answer(rows(items, "item_id long, text string"), "text")
    got = dec.find(rows(docs, "doc_id long, text string, leaks string"), "text", table, "item_id", "question", "answer").collect()
    assert {(r.doc_id, r.text): [x.item for x in r.leaks] for r in got} == {
        (d, t): found for (d, t, _), found in zip(docs, [[3], [], [], [], [0, 103], [None], [], []], strict=True)
    }
    none = dec.find(rows(docs, "doc_id long, text string, x string"), "text", table.limit(0), "item_id", "question")
    assert all(r.leaks == [] for r in none.collect())


def test_short_items_and_unspaced_scripts(rows):
    """The query's search finds items of few words by a run of all of them, and by characters where there are no blanks."""
    items = [
        (1, "What is the capital of France? Paris."), (2, "Quito"), (3, "今天天气很好我们一起去公园散步吧"), (4, "水の都"), (5, "ประเทศไทย"),
        (6, "..."), (None, "no id here"), (7, "What is the capital of France? Paris."),
    ]
    docs = [
        (1, "so, WHAT is the capital of france - paris and more"), (2, "what is the capital of France? It is Paris."), (3, "Quitos mosquito"),
        (4, "他说：今天天气很好我们一起去公园散步吧，然后回家。"), (5, "ここは水の都です"), (6, "เที่ยวประเทศไทยกัน Quito"), (7, "水の 今天天气"),
        (8, "there is no id"), (9, "here"), (10, "No id; here"), (11, None), (12, "capital of France? Paris. What is the"),
    ]
    got = leaks(rows(docs, "doc_id long, text string"), rows(items, "item_id long, text string")).collect()
    want = {1: [1, 7], 4: [3], 5: [4], 6: [2, 5], 10: [None]}
    assert {r.doc_id: [x.item for x in r.leaks] for r in got} == {d: want.get(d, []) for d, _ in docs}


def test_items_without_answers_count_as_a_whole(rows):
    """A changed or cut word in a short last sentence loses no passage, whatever its length; little of a passage is none."""
    rng = random.Random(8)
    items = [(i, _prose(rng, n) + ". " + _prose(rng, last) + ".") for i, (n, last) in enumerate([(30, 1), (30, 2), (60, 1), (80, 1), (20, 5)])]
    docs = []
    for i, text in items:
        own = text.split()
        docs += [(i, " ".join([*own[:-1], "other"])), (i, " ".join([_prose(rng, 90), *own[:-2]])), (9, " ".join(own[-12:]))]
    got = leaks(rows(docs, "doc_id long, text string"), rows(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.text): [x.item for x in r.leaks] for r in got} == {(d, t): [d] if d < 9 else [] for d, t in docs}


def _vectors(n, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, size))
    return centres[rng.integers(0, 8, n)] + 0.5 * rng.normal(size=(n, size))


def test_probing_finds_all_codes_in_a_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (300, 2), dtype=np.uint16)
    codes[::3] = codes[0] ^ (np.uint16(1) << rng.integers(0, 16, (100, 2), dtype=np.uint16))
    for radius in (0, 1, 3, 5, 9):
        got = {(a, b) for q, r in nearest.within(codes, codes[:40], radius) for a, b in zip(q.tolist(), r.tolist(), strict=True)}
        near = nearest.distances(codes[:40, None], codes[None]) <= radius
        assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_nearest_against_brute_force(rows):
    x = _vectors(1500, 32, 2)
    x[700:760] = x[0]  # copies: ties to the smaller id
    data = [(i, [float(v) for v in row], "clash") for i, row in enumerate(x)]
    data += [(2000, None, ""), (2100, [0.0] * 32, ""), (2200, [float("nan")] * 32, ""), (2300, [None] + [1.0] * 31, ""), (2400, [1.0], ""), data[5]]
    got = nearest.nearest(rows(data, "vec_id long, embedding array<double>, rank string"), "vec_id", "embedding", F.col("vec_id") % 100 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(by) == list(range(0, 1500, 100))
    hit = 0
    for q, found in by.items():
        exact = np.sqrt(((x - x[q]) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(1500), exact)) if i != q][:10]
        assert len(found) == 10 and all(abs(s - exact[i]) < 1e-9 for i, s in found)
        assert found == sorted(found, key=lambda f: (f[1], f[0]))
        hit += len({i for i, _ in found} & set(best))
    assert hit >= 0.9 * 10 * len(by)
    assert [i for i, _ in by[700]] == [0, 701, 702, 703, 704, 705, 706, 707, 708, 709]


@pytest.mark.parametrize("n, want", [(0, 0), (1, 0), (4, 3)])
def test_few_vectors(rows, n, want):
    data = [(i * 100, [1.0 + i, 2.0]) for i in range(n)]
    assert nearest.nearest(rows(data, "vec_id long, embedding array<double>"), "vec_id", "embedding", F.col("vec_id") % 100 == 0).count() == n * want


def _sets(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def test_jaccard_join_against_brute_force(rows):
    rng = random.Random(9)
    docs = []
    for g in range(25):
        base = _prose(rng, rng.randint(1, 160)).split()
        for _ in range(rng.randint(1, 12)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            docs.append((len(docs) * 3, " ".join(own)))
    docs += [(9000, None), (9001, ""), (9002, " \t"), (9003, docs[0][1].upper()), (9004, docs[0][1])]
    for rule in (jaccard_tree.Rule(4, 85), jaccard_tree.Rule()):
        sets = {i: _sets(t, rule.words) for i, t in docs}
        root = {i: i for i in sets}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b]) and sets[b]:
                    root[max(find(a), find(b))] = min(find(a), find(b))
        got = {r.doc_id: (r["size"], r.component) for r in jaccard_tree.join(rows(docs, "doc_id long, text string"), "doc_id", "text", rule).collect()}
        assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_bins_bound_the_overlap_of_long_sets(rows):
    """Long texts link exactly where brute force links them, and unrelated ones are dropped before sets are compared."""
    rng = random.Random(4)
    rule, docs = jaccard_tree.Rule(4, 85), []
    for g in range(4):
        base = _prose(rng, 1500 + 900 * g).split()
        for changes in (0, 5, 40, 75, 200):
            own = list(base)
            for at in rng.sample(range(len(own)), changes):
                own[at] = rng.choice(WORDS)
            docs.append((len(docs), " ".join(own)))
    sets = {i: _sets(t, 4) for i, t in docs}
    alike = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    df = rows(docs, "doc_id long, text string")
    got = {r.doc_id: r.component for r in jaccard_tree.join(df, "doc_id", "text", rule).collect()}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in alike:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root
    classes = jaccard_tree.profiles(df, "doc_id", "text", rule).withColumnRenamed("doc_id", "id")
    pairs = rows([(a, b, True) for a in sets for b in sets if a < b], "a long, b long, long boolean")
    kept = {(r.a, r.b) for r in jaccard_tree.plausible(pairs, classes, rule).collect()}
    assert alike <= kept and all(a // 5 == b // 5 for a, b in kept)


def test_components_stop_when_only_stars_are_left(spark, monkeypatch):
    """A star is written once, not once more to see that nothing changes; a chain takes its rounds and gives one root."""
    written = []
    monkeypatch.setattr(components_, "stage", lambda df, name: written.append(name) or stage(df, name))
    star = spark.createDataFrame([(k, 0) for k in range(1, 9)] + [(None, 3), (4, None), (5, 5)], "a long, b long")
    assert {tuple(r) for r in components_.components(star).collect()} == {(k, 0) for k in range(1, 9)}
    assert len(written) == 1
    chain = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(40, 41)], "a long, b long")
    assert {tuple(r) for r in components_.components(chain).collect()} == {(k, 0) for k in range(1, 21)} | {(41, 40)}
    assert components_.components(chain.limit(0)).count() == 0
