"""Hard negatives, removal of repeated passages and phrases against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidesift.llm import blocks as bl, hard_negatives as hn, phrases as ph, substrings as sub
from tidesift.llm.queries import QUERIES
from tests.llm.test_search import WORDS, _prose

# -- hard negatives ------------------------------------------------------------


def _mined(data, rule=hn.Rule()):
    """By hand; ``data`` has distinct ``(id, label, vector)``."""
    out = set()
    for key, (i, label, x) in enumerate(data):
        if i % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), j, k) for k, (j, _, y) in enumerate(data) if k != key]
        same = sorted(s for s in scores if data[s[2]][1] == label)[: rule.positives]
        other = sorted(s for s in scores if data[s[2]][1] != label)
        for p, j, _ in same:
            fits = [s for s in other if rule.low * -p <= 100 * -s[0] <= rule.high * -p][: rule.negatives]
            out |= {(i, j, rank, k, -p, -s) for rank, (s, k, _) in enumerate(fits, 1)}
    return out


def _clustered(n, size, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size)) * rng.uniform(0.2, 3, (6, 1))
    x = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, size))
    return np.floor(256 * x).astype(int).tolist()


@pytest.mark.parametrize("tile, rows_least", [(512, 4096), (16, 64)])
def test_hard_negatives_equal_brute_force(rows, monkeypatch, tile, rows_least):
    monkeypatch.setattr(hn, "LEAST_ROWS", rows_least)
    monkeypatch.setattr(hn, "TILE", tile)
    data = [(i, i % 3, v) for i, v in enumerate(_clustered(600, 8, 4))]
    data += [(1000 + i, i % 2, [5, 0, 0, 0, 0, 0, 0, 0]) for i in range(40)]  # equal vectors: ties to the smaller id
    data += [(2000, 0, [0] * 8), (2050, 1, [-(1 << 27)] * 8), (2051, 1, [1 << 27] * 8), (2052, 0, [-(1 << 27)] * 8), (2100, 7, [1] * 8)]
    odd = [(None, 0, [1] * 8), (2200, None, [1] * 8), (2250, 0, None), (2300, 0, [1, None] + [1] * 6), (2350, 0, [1] * 7), (2400, 0, [1 << 31] * 8), data[3], data[50]]
    df = rows([(i, l, v, "x") for i, l, v in data + odd], "vec_id long, label int, vector array<long>, score string")
    for rule in (hn.Rule(), hn.Rule(2, 4, 10, 99)):
        got = hn.mine(df, "vec_id", "label", "vector", F.col("vec_id") % 50 == 0, rule).collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == _mined(data, rule)


def test_rows_that_share_an_id_are_told_apart(rows):
    data = [(0, 1, [10, 0]), (0, 1, [9, 1]), (1, 1, [10, 1]), (2, 2, [9, 0]), (3, 2, [6, 2])]
    got = hn.mine(rows(data, "id long, label int, v array<int>"), "id", "label", "v", F.col("id") == 0).collect()
    assert {tuple(r) for r in got} == _mined(data)


def test_angles_bound_all_scores():
    rng = np.random.default_rng(6)
    x = np.floor(np.concatenate([rng.normal(size=(300, 5)) * 50, rng.normal(size=(300, 5)) + 400, np.zeros((3, 5))]))
    theta, norms = hn.angles(x, hn.directions(x, 4))
    order = np.lexsort((theta[:, 0], theta.argmin(1)))
    x, theta, norms = x[order], theta[order], norms[order]
    starts = np.arange(0, len(x), 16)
    parts = [f.reduceat(v, starts) for v in (theta, norms) for f in (np.minimum, np.maximum)]
    down, up = hn.intervals(theta, norms, *parts)
    scores = x @ x.T
    assert (np.maximum.reduceat(scores, starts, axis=1) <= up).all() and (np.minimum.reduceat(scores, starts, axis=1) >= down).all()
    assert (up < (norms[:, None] * parts[3][None])).mean() > 0.2  # and tells something


def test_whole_numbers_and_empty_tables(spark, rows):
    df = rows([(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, None), (4, [None, 1.0]), (5, [])], "id int, v array<float>")
    assert [r[0] for r in df.orderBy("id").select(hn.whole("v")).collect()] == [[128, -1], None, None, None, []]
    none = rows([], "vec_id long, label int, vector array<int>")
    assert hn.mine(none, "vec_id", "label", "vector", F.col("vec_id") % 50 == 0).collect() == []


# -- repeated passages -----------------------------------------------------------


def _kept(docs, size):
    """``docs`` in order: words left of each."""
    seen, out = set(), []
    for text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            window = tuple(words[i : i + size])
            if window in seen:
                gone[i : i + size] = [True] * size
            seen.add(window)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


@pytest.mark.parametrize("size, block", [(20, 1 << 23), (20, 3000), (5, 700), (1, 2000)])
def test_repeats_equal_brute_force(rows, monkeypatch, size, block):
    monkeypatch.setattr(bl, "BLOCK", block)
    rng = random.Random(size)
    passage, odd = _prose(rng, 60), "été x ❶ \x1f"
    texts = [_prose(rng, rng.randint(0, 80)) for _ in range(60)]
    texts += [_prose(rng, 10) + "\n" + passage + " \t" + _prose(rng, 5) for _ in range(12)] + [texts[3], texts[3].replace(" ", "\r\n"), None, "", " \n"]
    texts += ["a " * 90, ("b c " * 40), (odd + " ") * 30, passage[: len(passage) // 2], _prose(rng, 30) * 1]
    rng.shuffle(texts)
    df = rows([(i * 7, t, "mine", None) for i, t in enumerate(texts)], "doc_id long, text string, kept string, block int")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in sub.remove_repeats(df, "doc_id", "text", size).collect()}
    assert got == {i * 7: k for i, k in enumerate(_kept(texts, size))}
    columns = sub.remove_repeats(df, "doc_id", "text", size).columns
    assert columns == ["doc_id", "text", "block", "n_words", "n_removed", "kept"]


def test_repeats_with_null_and_repeated_ids(rows):
    rng = random.Random(2)
    a, b = _prose(rng, 40), _prose(rng, 40)
    data = [(None, a), (5, a), (None, b), (None, b), (7, _prose(rng, 5) + " " + a), (7, a)]
    got = Counter((r.doc_id, r.text, r.n_removed) for r in sub.remove_repeats(rows(data, "doc_id long, text string"), "doc_id", "text").collect())
    assert got[None, a, 40] == 1 and got[5, a, 0] == 1 and got[None, b, 40] == 1 and got[None, b, 0] == 1
    assert got[7, data[4][1], 40] == 1 and got[7, a, 40] == 1
    assert sub.remove_repeats(rows([], "doc_id long, text string"), "doc_id", "text").collect() == []


def test_long_text_without_blanks_and_very_long_text(rows):
    rng = random.Random(3)
    long = _prose(rng, 60_000)
    data = [(1, "x" * 600_000), (2, long), (3, "start " + long)]
    got = {r.doc_id: (r.n_words, r.n_removed, len(r.kept)) for r in sub.remove_repeats(rows(data, "doc_id long, text string"), "doc_id", "text").collect()}
    assert got == {1: (1, 0, 600_000), 2: (60_000, 0, len(long)), 3: (60_001, 60_000, 5)}


def test_query_of_repeats_hashes_the_words_left(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op12_substrings"](spark, sf_dir).collect()}
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for (doc_id, _), (n, removed, kept) in zip(docs, _kept([t for _, t in docs], 20), strict=True):
        assert tuple(got[doc_id]) == (doc_id, n, removed, hashlib.sha256(kept.encode()).hexdigest())


def test_anchor_is_the_first_least_value():
    rng = random.Random(4)
    values = [rng.randint(0, 5) for _ in range(200)]
    for width in (1, 2, 3, 8, 11):
        want = [min(range(i, i + width), key=lambda j: (values[j], j)) for i in range(len(values) - width + 1)]
        assert sub.least_in(np.array(values), width).tolist() == want


def test_packs_come_back():
    rng = np.random.default_rng(5)
    for bits, n in ((8, 30), (30, 500), (62, 400)):
        cells = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64))
        counts = rng.integers(1, 9, len(cells)).astype(np.uint8)
        parts = bl.ranges(cells, bits, 7).astype(np.int64)
        assert (np.diff(parts) >= 0).all() and parts.max() < 7
        packs = list(bl.pack(cells, counts, parts))
        assert np.concatenate([bl.unpack(c, len(k)) for _, c, k in packs]).tolist() == cells.tolist()
        assert b"".join(k for _, _, k in packs) == counts.tobytes()


# -- phrases ---------------------------------------------------------------------


def _phrases(docs, rule):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, rule.words + 1):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) >= 2 and a >= rule.threshold}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= rule.inside * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[: rule.first], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, rule", [(1 << 23, ph.Rule()), (1500, ph.Rule()), (4000, ph.Rule(4, 3, 70, 5)), (2000, ph.Rule(2, 300, 50, 9))])
def test_phrases_equal_brute_force(rows, monkeypatch, block, rule):
    monkeypatch.setattr(bl, "BLOCK", block)
    rng = random.Random(7)
    few = WORDS[:9] + ["Été", "A", "❶ x", "z\x1cz"]
    texts = []
    for i in range(150):
        words = [rng.choice(few) if rng.random() < 0.8 else rng.choice(WORDS) for _ in range(rng.randint(0, 40))]
        texts.append((rng.choice([" ", "  ", "\t"]).join(w + rng.choice(["", "", "", ",", "!", "\n"]) for w in words), rng.choice(["en", "de", None, "und"])))
    texts += [(None, "en"), ("", "xx"), (" \t.", "de")] + [("new york city is big", "en")] * 30 + [("New York", None)] * 12 + [("y y y y y y y y y y y y", "yy")] * 40
    df = rows([(i, t, l, "c") for i, (t, l) in enumerate(texts)], "doc_id long, text string, lang string, block string")
    got = ph.collocations(df, "text", F.coalesce("lang", F.lit("und")), rule).collect()
    assert sorted(map(tuple, got)) == _phrases(texts, rule)


def test_phrases_of_nothing(rows):
    empty = rows([], "text string, lang string")
    assert ph.collocations(empty, "text", F.coalesce("lang", F.lit("und"))).collect() == []


def test_misra_gries_loses_no_frequent_key():
    rng = np.random.default_rng(8)
    for capacity, runs in product((1, 7, 40, 10_000), (1, 5, 60)):
        values = np.where(rng.random(5000) < 0.5, rng.zipf(1.4, 5000) % 300, rng.integers(300, 9000, 5000)).astype(np.uint64)
        parts = [np.unique(x, return_counts=True) for x in np.array_split(values, runs)]
        keys, counts, lost = ph.misra_gries(iter(parts), capacity)
        true = Counter(values.tolist())
        assert len(keys) <= capacity and lost <= len(values) / (capacity + 1)
        left = dict(zip(keys.tolist(), counts.tolist()))
        assert all(left.get(k, 0) <= n <= left.get(k, 0) + lost for k, n in true.items())


def test_survivors_hold_all_frequent_cells():
    rng = np.random.default_rng(9)
    packs, true = [], Counter()
    for block in range(9):
        cells, counts = np.unique(rng.zipf(1.3, 900) % 4000, return_counts=True)
        true.update(dict(zip(cells.tolist(), counts.tolist())))
        counts = np.minimum(counts, 10).astype(np.uint8)
        packs += [(block, *p) for p in bl.pack(cells.astype(np.uint64), counts, np.zeros(len(cells), np.int64))]
    table = bl.rows_of({"block": pa.int32(), "range": pa.int64(), "cells": pa.binary(), "counts": pa.binary()}, packs)
    found = ph._survivors(table, np.uint8, 10)
    for (cells, _), marks in zip(bl.unpacked(table, np.uint8), found["marks"], strict=True):
        alive = np.unpackbits(np.frombuffer(marks.as_py(), np.uint8), count=len(cells)).astype(bool)
        assert all(a or true[c] < 10 for c, a in zip(cells.tolist(), alive.tolist()))
