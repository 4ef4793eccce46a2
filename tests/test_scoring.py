import pytest
from pyspark.sql import functions as F

from tidesift.operators import models, scoring as sc
from tidesift.operators.lexicon import CLASSES
from tidesift.operators.preprocess import default_tables, preprocess_for_scoring
from tidesift.plans import pipeline as pl
from tidesift.plans.catalog import base, labelling, learning, serving
from tidesift.sources import wordlists
from tidesift.streaming.score import read_requests, read_scored, score_batches, score_stream


@pytest.fixture(scope="module")
def lexicon(spark):
    return wordlists.lexicon_frame(spark, wordlists.POSITIVE | wordlists.NEGATIVE)


def test_ties_go_to_the_first_class(rows):
    df = rows([(0.4, 0.4, 0.2), (0.2, 0.4, 0.4), (0.3, 0.3, 0.4), (0.4, 0.2, 0.4)], "a double, b double, c double")
    probs = dict(zip(CLASSES, (F.col("a"), F.col("b"), F.col("c"))))
    assert [r[0] for r in df.select(sc.argmax_class(probs)).collect()] == ["Negatif", "Netral", "Positif", "Negatif"]


def test_blend_and_empty_results(spark, rows, lexicon):
    tables = default_tables(spark)
    df = rows([(1, "bagus sekali"), (2, None), (3, "  "), (4, "@x 123"), (5, "itu ini"), (6, "benci jelek")], "doc_id int, text string")
    ready = preprocess_for_scoring(df, tables)
    probs = dict(zip(CLASSES, (F.lit(0.5), F.lit(0.3), F.lit(0.2))))
    got = {r.doc_id: r for r in sc.score_given(ready, probs, lexicon, tables).collect()}
    assert len(got) == 6
    assert (got[1].sentiment, got[1].confidence, got[1].prob_Negatif) == ("Positif", 0.525, 0.275)
    assert (got[6].sentiment, got[6].confidence) == ("Negatif", 0.725)
    for i in (2, 3, 4, 5):
        r = got[i]
        assert (r.sentiment, r.confidence, r.text_preprocessed, r.prob_Negatif, r.prob_Netral, r.prob_Positif) == ("Netral", 0.0, "", 0.0, 0.0, 0.0)


def test_summary_line(spark, rows, lexicon):
    scored = sc.score_lexicon(rows([(1, "bagus " * 20)], "doc_id int, text string"), lexicon, default_tables(spark))
    row = sc.prediction_summary(scored).first()
    assert row.text == ("bagus " * 20)[:50] + "..." and row.confidence == "95.00%"


@pytest.fixture
def requests(rows):
    return rows(
        [("1", "a", "bagus"), ("2", "b", "jelek"), ("3", "nope", "bagus"), ("4", "a", " "), ("5", None, "x"), ("6", "a", None)],
        "doc_id string, model string, text string",
    )


def scorers(spark, lexicon):
    tables = default_tables(spark)
    return {k: lambda df: sc.score_lexicon(df, lexicon, tables) for k in ("a", "b")}


def test_routes(spark, requests, lexicon):
    got = {r.doc_id: (r.sentiment, r.error) for r in sc.route_by_model(requests, scorers(spark, lexicon)).collect()}
    assert got == {
        "1": ("Positif", None), "2": ("Negatif", None), "3": (None, sc.UNKNOWN_MODEL), "4": (None, sc.EMPTY_TEXT),
        "5": (None, sc.UNKNOWN_MODEL), "6": (None, sc.EMPTY_TEXT),
    }


def test_stream_equals_batch_and_restarts(spark, requests, lexicon, tmp_path):
    source, sink, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    route = scorers(spark, lexicon)
    for part in ("doc_id <= '3'", "doc_id > '3'"):
        requests.filter(part).write.mode("append").parquet(source)
        stream = read_requests(spark, source, requests.schema, files_per_batch=1)
        score_stream(stream, route, sink, log).awaitTermination()
    batch = sc.route_by_model(requests, route)
    assert sorted(map(str, spark.read.parquet(sink).select(batch.columns).collect())) == sorted(map(str, batch.collect()))


@pytest.mark.parametrize("kind", ["random-forest", "softmax"])
def test_saved_classifier_scores_the_same(spark, sf_dir, tmp_path, kind):
    settings = {"num_trees": 3, "max_depth": 3} if kind == "random-forest" else {"max_iter": 5}
    result = pl.train(base.labelled(spark, sf_dir), pl.TrainOptions(kind, max_features=100, settings=settings))
    labelled = base.labelled(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.col("doc_id") * 86_400))
    pl.save_run(result, spark, str(tmp_path / "model"), str(tmp_path / "reports"), labelled, "ts")
    text = spark.read.text(str(tmp_path / "reports/classification_report_base_text"), wholetext=True).first()[0]
    assert "precision" in text and all(c in text for c in CLASSES)
    assert {"trend_month", "top_words", "label_distribution"} <= {p.name for p in (tmp_path / "reports").iterdir()}
    record = pl.load_metadata(spark, str(tmp_path / "model"))
    assert record["best_params"].items() >= {k: str(v) for k, v in settings.items()}.items()
    if kind == "softmax":
        assert record["training_args"]["max_iter"] == 5 and record["best_params"]["reg"] == "0.01"
        assert abs(record["performance"]["train_accuracy"] - record["performance"]["test_accuracy"] - record["performance"]["train_test_gap"]) < 2e-4
    else:
        assert record["best_params"]["min_samples_leaf"] == "2"
    assert spark.read.option("header", True).csv(str(tmp_path / "reports/model_comparison")).count() == 1
    loaded = pl.load_classifier(spark, str(tmp_path / "model"))
    assert pl.load_metadata(spark, str(tmp_path / "model"))["label_mapping"] == {c: k for k, c in enumerate(CLASSES)}
    texts = base.documents(spark, sf_dir, "doc_id", "text")
    score = lambda f: sorted(map(str, sc.score_plain(texts, f, base.tables(spark)).collect()))
    scored = score(result.fitted)
    assert scored == score(loaded) and len(scored) == 200
    probs = sc.score_plain(texts, loaded, base.tables(spark)).filter("confidence > 0").select(sum(F.col(f"prob_{c}") for c in CLASSES))
    assert all(abs(r[0] - 1) < 2e-4 for r in probs.collect())


def test_missing_classifier(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        pl.load_classifier(spark, str(tmp_path / "none"))
    path = str(tmp_path / "broken")
    spark.createDataFrame([('{"kind": "none"',)], "value string").write.text(f"{path}/metadata")
    with pytest.raises(ValueError):  # what is there but cannot be read is no missing classifier
        pl.load_classifier(spark, path)


def test_unknown_order(spark, sf_dir):
    with pytest.raises(ValueError):
        pl.split_rows(base.labelled(spark, sf_dir), pl.TrainOptions(order="other"))


def test_split_first_keeps_test_rows_apart(spark, sf_dir):
    rows = pl.split_rows(base.labelled(spark, sf_dir), pl.TrainOptions(order="split_then_resample"))
    train, test = (rows.filter(F.col("split") == s).select("doc_id") for s in ("train", "test"))
    assert train.intersect(test).count() == 0 and test.count() == test.distinct().count()


def test_large_lexicon_goes_by_join(spark, sf_dir, monkeypatch):
    from tidesift.operators import lexicon as lx

    light = labelling._light(spark, sf_dir)
    table = labelling.corpus_lexicon(spark, sf_dir)
    small = sorted(map(tuple, lx.lexicon_score(light, table, base.NEGATIONS).select("doc_id", "score").collect()))
    monkeypatch.setattr(lx, "small_map", lambda *a: None)
    assert sorted(map(tuple, lx.lexicon_score(light, table, base.NEGATIONS).select("doc_id", "score").collect())) == small


def test_leaderboard_is_sorted(spark):
    board = models.search_leaderboard(spark.range(1), [{"a": 1}, {"a": None}], [0.2, 0.7])
    assert [(r.candidate, r.params["a"]) for r in board.collect()] == [(1, "None"), (0, "1")]


def test_tuning_space_of_the_queries_is_part_of_the_real_one():
    from tidesift.operators.sampling import PARAM_SPACE

    assert set(learning.SPACE) <= set(PARAM_SPACE)


def test_routes_share_one_reading(spark, requests, lexicon, tmp_path):
    """Any number of models in one plan with one scan, with the results of a reading for each."""
    tables = default_tables(spark)
    path = str(tmp_path / "requests")
    requests.write.parquet(path)
    rows_ = spark.read.parquet(path)
    other = wordlists.lexicon_frame(spark, {"bagus": -9})
    routes = {"a": sc.Route(tables, lexicon), "b": sc.Route(tables, lexicon, negated=False), "c": sc.Route(tables, other)}
    got = sc.route_by_model(rows_, routes)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    plain = {k: lambda df, r=r: sc.score_lexicon(df, r.lexicon, tables, negated=r.negated) for k, r in routes.items()}
    want = sc.route_by_model(rows_, plain).select(got.columns)
    mixed = sc.route_by_model(rows_, plain | {"a": routes["a"]}).select(got.columns)
    as_list = lambda df: sorted(map(str, df.collect()))
    assert as_list(got) == as_list(want) == as_list(mixed)


def test_routes_by_classifiers_equal_their_scorers(spark, sf_dir, lexicon):
    labelled, tables = base.labelled(spark, sf_dir), base.tables(spark)
    forest = pl.train(labelled, pl.TrainOptions(max_features=50, settings={"num_trees": 3, "max_depth": 3})).fitted
    softmax = pl.train(labelled, pl.TrainOptions("softmax", max_features=50, settings={"max_iter": 3})).fitted
    routes = {"blend": sc.Route(tables, base.lexicon(spark), forest), "plain": sc.Route(tables, fitted=forest), "light": sc.Route(tables, fitted=softmax)}
    asked = base.documents(spark, sf_dir, "doc_id", "text").withColumn("model", F.element_at(F.array(*map(F.lit, routes)), (F.col("doc_id") % 3 + 1).cast("int")))
    got = {r.doc_id: r for r in sc.route_by_model(asked, routes).drop("model", "error").collect()}
    lex = base.lexicon(spark)
    want = [
        sc.score_blended(asked.where("model = 'blend'").drop("model"), forest, lex, tables),
        sc.score_plain(asked.where("model = 'plain'").drop("model"), forest, tables),
        sc.score_plain(asked.where("model = 'light'").drop("model"), softmax, tables),
    ]
    rows_ = [r for df in want for r in df.collect()]
    assert len(rows_) == len(got) == 200 and all(tuple(r) == tuple(got[r.doc_id]) for r in rows_)
    plan = sc.route_by_model(asked, routes)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_large_dictionaries_on_a_stream(spark, rows, tmp_path, monkeypatch):
    """More words than a constant holds; batches come one by one, and one that is repeated replaces itself."""
    from tidesift.operators import joins

    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    letters = lambda n: str(n).translate(str.maketrans("0123456789", "abcdefghij"))  # noqa: E731 (digits are cleaned away)
    word = lambda c: F.concat(F.lit(c), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
    lexicon = spark.range(60_000).select(word("w").alias("word"), (F.col("id") % 7 - 3).cast("int").alias("weight"))
    tables = default_tables(spark)
    tables.word_map = spark.range(60_000).select(word("x").alias("word"), word("w").alias("formal"))
    data = [(str(i), "m", f"w{letters(i)} tidak w{letters(i * 31)} x{letters(i * 17)} zz") for i in range(40)] + [("n", "m", " "), ("o", "?", "wb")]
    requests = rows(data, "doc_id string, model string, text string")
    route = {"m": sc.Route(tables, lexicon)}
    source, sink, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for part in ("doc_id <= '2'", "doc_id > '2'"):
        requests.filter(part).write.mode("append").parquet(source)
        stream = read_requests(spark, source, requests.schema, files_per_batch=2)
        score_batches(stream, route, sink, log).awaitTermination()
    import glob, os

    last = max(glob.glob(f"{log}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for path in (last, f"{log}/commits/.{os.path.basename(last)}.crc"):
        if os.path.exists(path):
            os.remove(path)  # as if the job had died before it noted the batch
    score_batches(read_requests(spark, source, requests.schema, files_per_batch=2), route, sink, log).awaitTermination()
    batch = sc.route_by_model(requests, route)
    got = read_scored(spark, sink).select(batch.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and got.count() == 42
    weigh = lambda n: n % 7 - 3
    want = {}
    for i in range(40):
        turned, after = (i * 31, i * 17) if weigh(i * 31) else (i * 17, i * 31)
        total = weigh(i) - weigh(turned) + weigh(after)
        want[str(i)] = "Positif" if total > 0 else "Negatif" if total < 0 else "Netral"
    assert {r.doc_id: r.sentiment for r in got.where("error IS NULL").collect()} == want


@pytest.mark.parametrize("files", [1, 3])
def test_stream_of_a_table_in_several_files(spark, rows, tmp_path, files):
    """The files of a table that is a folder have names of their own; a table may also be one file."""
    data = [(k, 0, role, text) for k, (role, text) in enumerate([("user", "for with"), ("assistant", "not was"), ("system", "x"), ("user", " "), ("user", None)])]
    df = rows(data, "conv_id long, turn long, role string, text string")
    if files == 1:
        df.coalesce(1).write.parquet(str(tmp_path / "part"))
        next((tmp_path / "part").glob("*.parquet")).rename(tmp_path / "conversations.parquet")
    else:
        df.repartition(files).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.doc_id: (r.sentiment, r.error) for r in serving.score_stream_requests(spark, str(tmp_path)).collect()}
    assert got == {"0:0": ("Positif", None), "1:0": ("Negatif", None), "2:0": (None, "unknown model"), "3:0": (None, "text must not be empty"), "4:0": (None, "text must not be empty")}


@pytest.mark.parametrize("inner", [["role"], []])
def test_stream_reads_the_rows_that_a_batch_reads(spark, rows, tmp_path, inner):
    """A table in folders by a column's values; and none of the rows of a table whose name begins like its own."""
    df = rows([(k, 0, role, "for with") for k, role in enumerate(["user", "assistant", "user"])], "conv_id long, turn long, role string, text string")
    df.write.partitionBy(*inner).parquet(str(tmp_path / "conversations.parquet"))
    df.write.parquet(str(tmp_path / "conversations_old.parquet"))
    got = sorted((r.doc_id, r.model, r.sentiment) for r in serving.score_stream_requests(spark, str(tmp_path)).collect())
    assert got == [("0:0", "user", "Positif"), ("1:0", "assistant", "Positif"), ("2:0", "user", "Positif")]
