"""Classifiers by held-out accuracy; token ids against the libraries; stages of the pipeline."""
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidesift.llm import chunks, langid_cnn, quality, sentencepiece_table, simple8b, token_files, toxicity
from tidesift.llm.queries import QUERIES, table
from tidesift.sources.scratch import scratch_path

MEDIUM = "/root/testdata/sf0.01"
ODD = [None, "", " ", "a", "  two  spaces ", "▁mark ▁", "tab\tand\nline", "é" * 50, "x" * 30000, "　wide\xa0space", "😀 emoji", "a", "word " * 5000]


def test_language_of_held_out_texts(spark):
    got = QUERIES["op2_language_id"](spark, MEDIUM).join(table(spark, MEDIUM, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    known = [r.lang == r.lang_pred for r in got if r.held_out and r.lang and r.text and any(c.isalpha() for c in r.text)]
    assert np.mean(known) > 0.9


@pytest.mark.parametrize("name, label, cut", [("op4_toxicity", "toxic", 0.5), ("op10_quality", "quality", 0.3)])
def test_labels_of_held_out_texts(spark, name, label, cut):
    got = QUERIES[name](spark, MEDIUM).join(table(spark, MEDIUM, "labels"), "doc_id", "left").collect()
    assert len(got) == 1000 and all(r.predicted == (r.score >= cut) for r in got)
    known = [(r[label], r.score) for r in got if r.held_out and r[label] is not None]
    ones, zeros = ([s for y, s in known if y == k] for k in (1, 0))
    assert np.mean([a > b for a in ones for b in zeros]) > 0.9


def test_odd_texts_get_scores(spark, rows):
    docs = rows([(i, t, "clash") for i, t in enumerate(ODD)], "doc_id long, text string, score string")
    train = rows([("good words here", 1.0), ("bad words there", 0.0), (None, 1.0)], "text string, label double")
    for module in (toxicity, quality):
        model = module.fit(train, "text", "label")
        got = module.score(docs, model, "text").collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert module.score(docs.limit(0), model, "text").count() == 0
        empty = module.fit(train.limit(0), "text", "label")
        assert module.score(docs, empty, "text").count() == len(ODD)
    model = langid_cnn.fit(rows([("der die das", "de"), ("the and of", "en"), ("x", None)], "text string, label string"), "text", "label")
    got = {r.doc_id: r.lang_pred for r in langid_cnn.predict(docs, model, "text").collect()}
    assert [got[i] for i in (0, 1, 2)] == ["und"] * 3 and got[3] in ("de", "en")


def test_pieces_equal_the_library(rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece_table.processor(path)
    docs = rows([(i, t, 7) for i, t in enumerate(ODD)], "doc_id long, text string, ids int")
    got = {r.doc_id: r for r in sentencepiece_table.encode(docs, "text", path).collect()}
    for i, t in enumerate(ODD):
        want = [*sp.encode(t or ""), sp.eos_id()]
        assert got[i].ids == want and got[i].decoded == sp.decode(want)


def test_token_files_equal_the_library(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = scratch_path(spark, "tokens")
    token_files.write(rows([(i * 2, t) for i, t in enumerate(ODD)], "doc_id long, text string"), out, "doc_id", "text", path, 2)
    got = sorted(token_files.read(spark, out).collect())
    library, start = token_files._tokenizer(path), 0
    for r, (i, t) in zip(got, enumerate(ODD), strict=True):
        want = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i * 2, start, len(want), want)
        start += len(want)
    crc = {r.doc_id: r.ids_crc32 for r in token_files.read(spark, out, token_files.id_checksums, "ids_crc32 long").collect()}
    assert crc == {r.doc_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}


def test_pieces_need_no_shuffle(spark, rows):
    """Rows stay where they are and nothing is staged, so that the work needs no disk; repeated rows stay repeated."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = rows([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    coded = sentencepiece_table.encode(docs, "text", path)
    assert "Exchange" not in coded._jdf.queryExecution().executedPlan().toString()
    assert coded.columns == ["doc_id", "ids", "decoded"]
    assert sorted((r.doc_id or 0, r.decoded) for r in coded.collect()) == [(0, ""), (1, "a b"), (1, "a b")]
    assert sentencepiece_table.encode(docs.limit(0), "text", path).count() == 0


def test_memory_keeps_frequent_chunks(monkeypatch):
    """Past its bound the memory forgets chunks that came once, and what it gives stays right."""
    asked = []

    def lengths(found):
        asked.extend(found.to_pylist())
        sizes = np.array([len(w) for w in found.to_pylist()], np.int64)
        return np.repeat(sizes, sizes), sizes

    monkeypatch.setattr(chunks, "REMEMBERED", 10)
    memory = chunks.ChunkMemory(lengths)
    for k in range(30):
        words = ["often", "", *("x" * (k + 3 + j) for j in (100, 200, 300))]
        ids, sizes = memory.find(pa.array(words))
        assert sizes.tolist() == [len(w) for w in words] and ids.tolist() == [len(w) for w in words for _ in w]
        assert len(memory.chunks) <= 10
    assert asked.count("often") == 1
    monkeypatch.setattr(chunks, "REMEMBERED_BYTES", 8)
    assert memory.find(pa.array(["often", "new"]))[1].tolist() == [5, 3] and not len(memory.chunks)


def test_slices_are_put_in_place_in_little_memory():
    """What a worker holds beyond the result does not grow by several whole numbers for each byte of it."""
    values, sizes = np.arange(40, dtype=np.uint8), np.array([0, 30, 1, 9], np.int64)
    codes = np.tile(np.array([1, 3, 0, 2, 1]), 40_000)
    tracemalloc.start()
    found = chunks.spread(values, sizes, codes)
    held = tracemalloc.get_traced_memory()[1] - found.nbytes
    tracemalloc.stop()
    ends = np.cumsum(sizes)
    want = np.concatenate([values[ends[c] - sizes[c] : ends[c]] for c in codes[:5]])
    assert found.tolist() == np.tile(want, 40_000).tolist() and not len(chunks.spread(values, sizes, codes[:0]))
    assert held < 6 * found.nbytes


def test_pieces_are_remembered_within_a_bound_of_their_own():
    """A table of pieces forgets before it holds as many chunks as a token table may."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    table = sentencepiece_table._table(path)
    for start in range(0, 400_000, 100_000):
        words = [f"{k:x}" for k in range(start, start + 100_000)]
        ids, sizes = table.find(pa.array(words))
        assert ids[: sizes[0]].tolist() == sentencepiece_table.processor(path).encode(words[0])
        assert len(sizes) == len(words) and len(table.chunks) <= 250_000


def test_joined_chunks_have_their_own_ids():
    """Chunks go through the tokenizer together; ends of texts, rare blanks and added tokens do not run into others."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*ODD, " x<|endoftext|>y <|endoftext|> z", " a\xa0", " b", "\n\n c\r\n", " d ", " e", "it's we'll 's ' s", "\x1c a \x85", " é 😀 中"]
    library = token_files._tokenizer(path)
    ids, counts = token_files.tokenize(pa.array(texts, pa.string()), path)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    cut, _, _ = chunks.by_word(pa.array(texts, pa.string()))
    many, sizes = token_files._encode(cut, path)
    each, alone = token_files._encode_each(cut.to_pylist(), path)
    assert many.tolist() == each.tolist() and sizes.tolist() == alone.tolist()


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for size in (0, 1, 5, 1023, 1024, 5000):
        values = rng.integers(0, 1 << 63, size, dtype=np.uint64) >> rng.integers(0, 64, size).astype(np.uint64)
        words, groups = simple8b.encode(values)
        assert np.array_equal(simple8b.decode(words), values) and groups.sum() == len(words)


def test_stages_against_brute_force(spark):
    """Copies and leaks that each stage leaves, and that it takes nothing else."""
    docs = table(spark, MEDIUM, "documents").withColumn("leaks", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    kept = pipeline.language(spark, docs, MEDIUM)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    gone = set(texts) - {r.doc_id for r in kept.collect()}
    assert all(not any(c.isalpha() for c in texts[i]) for i in gone) or len(gone) < 0.02 * len(texts)

    one = pipeline.one_of_each(spark, docs, MEDIUM)
    left = {r.doc_id for r in one.collect()}
    sets = {}
    for i, t in texts.items():
        w = "".join(c.lower() if c.isascii() else c for c in t).split(" ")
        w = [y for x in w for y in x.replace("\t", "\n").replace("\r", "\n").replace("\v", "\n").replace("\f", "\n").split("\n") if y]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    near = lambda a, b: sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    order = sorted(left)
    assert not [(a, b) for n, a in enumerate(order) for b in order[n + 1 :] if near(a, b)]
    for i in set(texts) - left:
        assert any(near(i, b) for b in texts if b != i)

    clean = {r.doc_id for r in pipeline.clean_of_benchmark(spark, docs, MEDIUM).collect()}
    flat = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [flat(r.text) for r in table(spark, MEDIUM, "benchmark").collect()]
    whole = {i for i, t in texts.items() if any(x in flat(t) for x in items)}
    assert set(texts) - clean == whole


def test_pipeline_gives_ids(spark, sf_dir):
    got = pipeline.run(spark, sf_dir)
    assert got.where((F.size("ids") != F.col("n_tokens")) | F.col("ids").isNull()).count() == 0 and got.count() > 50
