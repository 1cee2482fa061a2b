"""CSV in and out, assets, dictionaries, models."""

from datetime import datetime

import numpy as np
import pytest
from conftest import column
from pyspark.ml.classification import FMClassifier
from pyspark.sql import functions as F

from quizframe.operators import encode, metrics, models, windows
from quizframe.sources import answers as src
from quizframe.sources import assets

CSV = """userID,assessmentItemID,testId,answerCode,Timestamp,KnowledgeTag
7,A060001001,A060001,1,2020-03-24 00:17:11,7224
7,A060001002,A060001,0,2020-03-24 00:17:14,7225
3,A060001001,A060001,-1,2020-03-23 10:00:00,7224
"""


def write(folder, text, name="log.csv"):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_csv_keeps_file_order_and_time(spark, tmp_path):
    path = write(tmp_path, CSV)
    log = src.read_answers(spark, path, split=1)
    rows = log.orderBy("row_id").collect()
    assert [r["userID"] for r in rows] == [7, 7, 3]
    assert rows[0]["Timestamp"] == datetime(2020, 3, 24, 0, 17, 11)
    assert {r["split"] for r in rows} == {1}
    assert len({r["row_id"] for r in rows}) == 3
    text = src.read_answers(spark, path, split=1, parse_ts=False)
    assert text.orderBy("row_id").collect() == rows


def test_row_ids_differ_between_folders_with_equal_file_names(spark, tmp_path):
    for day in ("day1", "day2"):
        (tmp_path / day).mkdir()
        write(tmp_path / day, CSV)
    log = src.read_answers(spark, f"{tmp_path}/day*")
    assert log.count() == 6 and log.select("row_id").distinct().count() == 6


def test_scratch_tables_lie_in_one_folder_and_can_be_deleted(spark, make_log, tmp_path, monkeypatch):
    from quizframe import runtime

    log = make_log([(1, "A01000001001", 1, 0)])
    table = runtime.written(log, "x")
    assert table.count() == 1 and all(runtime.run_dir(spark) in f for f in table.inputFiles())
    monkeypatch.setattr(runtime, "shared_dir", lambda _: str(tmp_path))
    again = runtime.written(log, "x")
    assert again.count() == 1
    runtime.clean_up(spark)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        again.count()
    assert table.count() == 1


def test_csv_order_survives_many_file_splits(spark, tmp_path):
    body = "".join(f"{i},A06{i:04d}001,A06{i:04d},1,2020-01-01 00:00:00,1\n" for i in range(2000))
    path = write(tmp_path, CSV.splitlines()[0] + "\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        log = src.read_answers(spark, path)
        assert log.rdd.getNumPartitions() > 1
        assert column(log, "userID") == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_template_and_predictions(spark, tmp_path):
    template = src.read_template(spark, write(tmp_path, "id,prediction\n0,0.5\n1,0.5\n", "sub.csv"))
    assert template.count() == 2
    df = spark.createDataFrame([("b", 0.25), ("a", 0.75), ("c", 1.0)], "k STRING, prediction DOUBLE")
    out = str(tmp_path / "out")
    src.write_predictions(df, out, ["k"])
    back = src.read_template(spark, out).orderBy("id").collect()
    assert [(r["id"], r["prediction"]) for r in back] == [(0, 0.75), (1, 0.25), (2, 1.0)]


def test_union_logs_marks_split(make_log):
    log = make_log([(1, "A01000001001", 1, 0)]).drop("split")
    assert sorted(r["split"] for r in src.union_logs(log, log).collect()) == [0, 1]


def test_assets_round_trip_reads_one_folder(spark, make_log, tmp_path):
    log = make_log([(1, "A01000001001", 1, 0), (1, "A01000001002", 0, 1)])
    fitted = encode.fit_encoders(log, ["testId"], ["assessmentItemID"])
    assets.save_assets(fitted, str(tmp_path / "assets"))
    back = assets.load_assets(spark, str(tmp_path / "assets"), "value_counts_testId")
    assert [(r["key"], r["value"]) for r in back.collect()] == [("A01000001", 2.0)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asset" in plan


def test_dictionary_round_trip(spark, make_log, tmp_path):
    log = make_log([(1, "A01000001001", 1, 0), (1, "A01000001002", 0, 1)])
    dictionary = encode.fit_ordinal(log, ["assessmentItemID", "testId"])
    path = str(tmp_path / "dict")
    assets.save_dictionary(dictionary, path)
    sizes = {r["field"]: r["size"] for r in assets.cardinality(assets.load_dictionary(spark, path)).collect()}
    assert sizes == {"assessmentItemID": 3, "testId": 2}
    assert assets.load_dictionary(spark, path, "testId").count() == 2


def planted(spark, n=400):
    """The label is the sign of x."""
    return spark.range(n).select(
        F.col("id").alias("row_id"),
        ((F.col("id") * 37 % 101) - 50).cast("double").alias("x"),
        (F.col("id") % 7).cast("double").alias("noise"),
        F.when((F.col("id") * 37 % 101) - 50 > 0, 1).otherwise(0).alias("answerCode"),
    )


def auc_of(df):
    from quizframe.operators.metrics import auc

    return auc(df, "answerCode", "p").first()["auc"]


def test_boosting_finds_planted_signal(spark, tmp_path):
    df = planted(spark)
    train, valid = df.where("row_id % 4 < 3"), df.where("row_id % 4 = 3")
    model = models.fit_boosting(train, valid, ["x", "noise"], max_iter=3, max_depth=3)
    scored = models.score(model, models.filled(valid, ["x", "noise"]), "p")
    assert auc_of(scored) > 0.95
    models.save_model(model, str(tmp_path / "m"))
    again = models.score(models.load_model(str(tmp_path / "m")), models.filled(valid, ["x", "noise"]), "p")
    assert column(again, "p") == column(scored, "p")


def test_boosting_keeps_many_trees_and_beats_one(spark):
    df = spark.range(600).select(
        F.col("id").alias("row_id"),
        ((F.col("id") * 37 % 101) / 101).alias("x"),
        ((F.col("id") * 53 % 97) / 97).alias("z"),
    ).withColumn("answerCode", (F.col("x") + F.col("z") > 1).cast("int"))
    train, valid = df.where("row_id % 4 < 3"), df.where("row_id % 4 = 3")

    def fitted(trees):
        model = models.fit_boosting(train, valid, ["x", "z"], max_iter=trees, learning_rate=0.3, max_depth=3)
        return model, auc_of(models.score(model, models.filled(valid, ["x", "z"]), "p"))

    many, good = fitted(12)
    assert many.stages[-1].getNumTrees > 1
    assert good > fitted(1)[1]


def test_patience():
    assert models.best_round([5, 4, 3, 2], 2) == 4
    assert models.best_round([5, 4, 6, 6, 1], 2) == 2
    assert models.best_round([5, 4, 6, 6, 1], 3) == 5
    assert models.best_round([1, 1, 1], 5) == 1


def test_fm_finds_planted_interaction(spark):
    """Right exactly when both codes are equal: no single field tells."""
    df = spark.range(400).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 2).cast("int").alias("a"),
        (F.floor(F.col("id") / 2) % 2).cast("int").alias("b"),
    ).withColumn("answerCode", (F.col("a") == F.col("b")).cast("int"))
    fields = {"a": 2, "b": 2}
    for width in (None, 64):
        model = models.fit_fm(df, fields, factor_size=4, iterations=(100,), step_size=0.1, reg_param=0.0, hash_width=width)
        scored = models.score(model, models.fm_fields(df, fields), "p")
        assert auc_of(scored) > 0.95
    unseen = df.limit(1).withColumn("a", F.lit(None).cast("int"))
    assert 0 <= models.score(model, models.fm_fields(unseen, fields), "p").first()["p"] <= 1


def test_fm_keeps_the_iterations_that_do_best_on_held_out_rows(spark):
    """Labels without any signal: a long fit overfits, the chosen one is no worse than a constant."""
    df = spark.range(900).select(
        "id", (F.col("id") % 90).cast("int").alias("a"), (F.floor(F.col("id") / 10)).cast("int").alias("b"), (F.xxhash64("id") % 2 == 0).cast("int").alias("answerCode")
    )
    train, valid = df.where("pmod(xxhash64(id, 1), 4) < 3"), df.where("pmod(xxhash64(id, 1), 4) = 3")
    fields = {"a": 90, "b": 90}

    def loss(model):
        scored = models.score(model, models.fm_fields(valid, fields), "p")
        return scored.agg(metrics.rmse(F.col("answerCode"), F.col("p"))).first()[0]

    chosen = loss(models.fit_fm(train, fields, valid, step_size=0.1))
    assert chosen <= loss(models.fit_fm(train, fields, iterations=(60,), step_size=0.1, reg_param=0.0))
    assert chosen < 0.51


@pytest.mark.parametrize("width", [None, 4])
def test_fm_takes_the_steps_of_the_library_once(spark, monkeypatch, width):
    """Each model has the weights of a fit of its own, but no step is taken twice."""
    df = spark.range(300).select(
        (F.col("id") % 7).cast("int").alias("a"), (F.col("id") % 30).cast("int").alias("b"), (F.xxhash64("id") % 2 == 0).cast("int").alias("answerCode")
    )
    fields, steps, paths = {"a": 7, "b": 30}, [], []
    taken, walked = models._fm_gradient, models._fm_path
    monkeypatch.setattr(models, "_fm_gradient", lambda *a: steps.append(1) or taken(*a))

    def kept(*a):
        for model in walked(*a):
            paths.append(model)
            yield model

    monkeypatch.setattr(models, "_fm_path", kept)
    fitted = models.fit_fm(df, fields, df, factor_size=3, iterations=(1, 4, 6), hash_width=width)
    assert len(paths) > 1 and len(steps) == (1, 4, 6)[len(paths) - 1]
    rows = models.fm_fields(df, fields).withColumn("answerCode", F.col("answerCode").cast("double"))
    for stage in fitted.stages[:-1]:
        rows = stage.transform(rows)
    for found, n in zip(paths, (1, 4, 6)):
        own = FMClassifier(
            labelCol="answerCode", featuresCol="_x", factorSize=3, stepSize=0.05, regParam=0.01, seed=0, maxIter=n
        ).fit(rows)
        assert found.getMaxIter() == n
        assert found.factors.toArray().ravel() == pytest.approx(own.factors.toArray().ravel(), abs=1e-9)
        assert list(found.linear) == pytest.approx(list(own.linear), abs=1e-9)
        assert found.intercept == pytest.approx(own.intercept, abs=1e-9)


def test_fm_steps_read_blocks_whose_codes_lie_together(spark, monkeypatch):
    """A step meets a code of many in one task or two, and gets its rows as few blocks without column names."""
    df = spark.range(4000).select(
        F.pmod(F.xxhash64("id"), F.lit(500)).cast("int").alias("a"), (F.col("id") % 3).cast("int").alias("b"), (F.col("id") % 2).cast("int").alias("answerCode")
    )
    blocks, taken = [], models._fm_gradient

    def seen(coded, *rest):
        blocks.extend(coded.select("*", F.input_file_name().alias("file")).collect())
        return taken(coded, *rest)

    monkeypatch.setattr(models, "_fm_gradient", seen)
    models.fit_fm(df, {"a": 500, "b": 3}, factor_size=2, iterations=(1,))
    files = {}
    for r in blocks:
        for place in set(np.frombuffer(r["_at0"], np.int32).tolist()):
            files.setdefault(place, set()).add(r["file"])
    assert len(blocks) <= 2 * spark.sparkContext.defaultParallelism and len(files) == 500
    assert sum(map(len, files.values())) <= len(files) + spark.sparkContext.defaultParallelism
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        models.fit_fm(df.withColumn("answerCode", F.lit(2)), {"a": 500, "b": 3}, factor_size=2, iterations=(1,))


def test_first_trees_equal_a_model_grown_with_so_many(spark):
    df = planted(spark).withColumn("answerCode", F.when(F.col("noise") == 3, 1 - F.col("answerCode")).otherwise(F.col("answerCode")))
    from pyspark.ml import PipelineModel

    def grown(n):
        return models.fit_boosting(df, df.limit(0), ["x", "noise"], max_iter=n, max_depth=2, learning_rate=0.3)

    long, short = grown(7), grown(4)
    cut = models.first_trees(long.stages[1], 4)
    assert cut.getNumTrees == 4
    scores = [column(models.score(m, models.filled(df, ["x", "noise"]), "p"), "p") for m in (PipelineModel([long.stages[0], cut]), short)]
    assert scores[0] == scores[1]
    rows = long.stages[0].transform(df)
    staged = models.staged_auc(long.stages[1], rows, "answerCode")
    assert staged[3] == pytest.approx(auc_of(models.score(short, models.filled(df, ["x", "noise"]), "p")), abs=1e-12)
    assert models.staged_auc(long.stages[1], rows.where("answerCode = 1"), "answerCode") == []


def test_row_ids_with_strange_file_names_and_many_splits(spark, tmp_path):
    head, body = CSV.split("\n", 1)
    names = ["a b.csv", "c%20d.csv", "é.csv", "x+y#.csv"]
    for n, name in enumerate(names):
        write(tmp_path, head + "\n" + "".join(f"{n * 1000 + i},A060001001,A060001,1,2020-03-24 00:17:11,7225\n" for i in range(200)), name)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = src.read_answers(spark, str(tmp_path)).orderBy("row_id").select("userID", "row_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({r["row_id"] for r in rows}) == 800
    groups = [[r["userID"] for r in rows[at : at + 200]] for at in range(0, 800, 200)]
    assert all(g == list(range(g[0], g[0] + 200)) for g in groups)
    assert src.read_answers(spark, str(tmp_path)).schema["row_id"].dataType.simpleString() == "bigint"
    test = src.read_answers(spark, str(tmp_path), split=1)
    assert test.agg(F.min("row_id")).first()[0] > rows[-1]["row_id"]


def test_wide_fields_need_a_chosen_hash_width(spark):
    df = spark.createDataFrame([(1, 1, 1)], "row_id int, a int, answerCode int")
    with pytest.raises(ValueError, match="hash_width"):
        models.fit_fm(df, {"a": 1 << 30})


def test_calendar(make_log):
    log = make_log([(1, "A01000001007", 1, 3600 * 7)])
    row = windows.with_context_codes(windows.with_codes(windows.with_calendar(log))).first()
    assert (row["hour"], row["weekofyear"], row["timeDivide"]) == (7, 1, "morning")
    assert (row["category_high"], row["grade"], row["problem_num"], row["assessmentItemNumber"]) == ("1", 1, "007", 7)
