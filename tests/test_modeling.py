import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.operators import modeling
from tidemark.plans import training
from tidemark.session import literal_frame, scratch_path
from tidemark.sources import tables


def applications(frame, n=600):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        good = rng.random() < 0.4
        rows.append((i, int(good) if i % 10 else None, rng.gauss(1.5 if good else 0, 1), rng.gauss(0, 1), "Male" if i % 2 else "Female"))
    return frame(rows, "app_id long, target int, x double, noise double, gender string")


def test_split_is_disjoint_complete_and_independent_of_partitions(frame):
    df = applications(frame)
    train, test = modeling.train_test(df, "target", "app_id")
    a, b = {r["app_id"] for r in train.collect()}, {r["app_id"] for r in test.collect()}
    assert not a & b and len(a | b) == df.where("target is not null").count()
    assert 0.12 < len(b) / len(a | b) < 0.28
    again = modeling.train_test(df.repartition(7), "target", "app_id")[1]
    assert b == {r["app_id"] for r in again.collect()}
    other = modeling.train_test(df, "target", "app_id", seed=7)[1]
    assert b != {r["app_id"] for r in other.collect()}


def test_exact_shares(frame):
    df = applications(frame)
    got = modeling.stratified_split_exact(df, "target", "app_id").groupBy("target").agg(
        F.count("*").alias("n"), F.count_if("is_test").alias("test")
    )
    for r in got.collect():
        assert r["test"] == -(-r["n"] // 5)
    empty = modeling.stratified_split_exact(df.where("target is null"), "target", "app_id")
    assert empty.count() == 0


def test_recorded_class_weights(spark):
    df = spark.range(3203).select((F.col("id") < 458).cast("int").alias("y"))
    got = {r["y"]: r["class_weight"] for r in modeling.class_weights(df, "y").distinct().collect()}
    assert got[0] == pytest.approx(0.583424, abs=1e-6) and got[1] == pytest.approx(3.496725, abs=1e-6)


def test_fit_score_save_load_and_ablation(spark, frame):
    df = modeling.encode_gender(applications(frame))
    holes = df.withColumn("x", F.when(F.col("app_id") % 50 != 0, F.col("x")))
    train, test = modeling.train_test(holes, "target", "app_id")
    features = ["x", "noise", "gender_encoded"]
    model = modeling.fit_classifier(train, features, "target")
    scored = modeling.with_scores(model, test.dropna(subset=["x"]))
    assert scored.agg(F.min("score"), F.max("score")).first()[0] >= 0
    path = scratch_path(spark, "model")
    tables.save_model(model, path)
    loaded = {r["app_id"]: r["score"] for r in modeling.with_scores(tables.load_model(path), test.dropna(subset=["x"])).collect()}
    assert loaded == {r["app_id"]: r["score"] for r in scored.collect()}
    first = modeling.coefficient_table(spark, model).first()
    assert first["feature"] == "x" and first["coefficient"] > 0
    (r,) = modeling.feature_ablation(train, test.dropna(subset=["x"]), features, "target").collect()
    assert r["auc_with"] > 0.75 and abs(r["auc_difference"]) < 0.05


def test_certificate_tells_an_optimal_fit_from_another(spark, frame):
    df = modeling.encode_gender(applications(frame)).where("target is not null")
    weighted = modeling.class_weights(df, "target")
    features = ["x", "noise", "gender_encoded"]

    def largest(**params):
        model = modeling.classifier(features, "target", **params).fit(weighted)
        rows = modeling.certificate(model, weighted, "target").collect()
        assert [r["term"] for r in rows] == ["(intercept)", *features]
        return max(r["violation"] for r in rows)

    assert largest(tol=1e-14, max_iter=500) < 1e-6
    # a penalty with corners: terms that it holds at zero are optimal too
    assert largest(tol=1e-14, max_iter=500, elastic_net=0.7, reg_param=0.2) < 1e-6
    assert largest(max_iter=1) > 1e-3
    model = modeling.classifier(features, "target").fit(weighted)
    assert modeling.certificate(model, weighted.where("false"), "target").count() == 0
    holes = weighted.union(weighted.limit(1).withColumn("x", F.lit(None).cast("double")))
    assert modeling.certificate(model, holes, "target").first() == modeling.certificate(model, weighted, "target").first()


def test_scan_typed_casts_and_tolerates(spark, frame):
    path = scratch_path(spark, "people") + ".parquet"
    frame([(7, "x", 1), (8, "2.5", 2)], "id long, income string, extra int").write.parquet(path)
    rows = tables.scan(spark, path, tables.CUSTOMERS).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("7", None, 1), ("8", 2.5, 2)]


def test_scan_csv_keeps_leading_zeros(spark, frame):
    path = scratch_path(spark, "people-csv")
    frame([("007", "F", 31.0, 5.5)], "id string, gender string, age double, income double").write.option("header", True).csv(path)
    assert tuple(tables.scan(spark, path, tables.CUSTOMERS).first()) == ("007", "F", 31.0, 5.5)


def test_filter_reaches_the_scan(spark, frame):
    path = scratch_path(spark, "wide") + ".parquet"
    frame([("a", 1.0, 2)], "id string, income double, age int").write.parquet(path)
    schema = T.StructType([T.StructField("income", T.DoubleType()), T.StructField("age", T.DoubleType())])
    plan = tables.scan_typed(spark, path, schema).where("income > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(income,3.0)" in plan and "age" not in plan.split("ReadSchema")[1]


def test_reports_are_replaced_per_run_date(spark, frame):
    path = scratch_path(spark, "report")
    report = frame([("s", "m", None, 1.0)], "section string, metric string, label string, value double")
    for day in ("2024-01-01", "2024-01-02", "2024-01-01"):
        tables.write_report(report, path, day)
    assert spark.read.parquet(path).groupBy("run_date").count().where("count = 1").count() == 2


def test_an_empty_literal_frame(spark):
    assert literal_frame(spark, {"a": "int"}, []).count() == 0


def as_csv(df):
    """The table as a file with its columns in another order."""
    path = scratch_path(df.sparkSession, "applications-csv")
    df.select("outcome", "dt", "app_id", "amount", "id").write.option("header", True).csv(path)
    return path


def test_whole_flow(spark, frame):
    rng = random.Random(12)
    people, asked, moves, number = [], [], [], 0
    for i in range(120):
        who = f"{i:04d}"
        people.append((who, rng.choice([" f", "M", None]), float(rng.randrange(18, 80)), None if i % 17 == 0 else float(rng.randrange(1000, 9000))))
        for _ in range(30):
            moves.append((who, f"2024-{rng.randrange(1, 7):02d}-{rng.randrange(1, 28):02d}", rng.uniform(-500, 600), None if rng.random() < 0.02 else rng.uniform(-50, 3000)))
        for _ in range(rng.randrange(5) if i % 4 else 0):
            number += 1
            asked.append((who, number, f"2024-{rng.randrange(1, 12):02d}-01", rng.uniform(100, 900), rng.choice(["TakeUp", "Declined", "Declined", None])))
    out = scratch_path(spark, "run")
    model = training.run(
        frame(people, "id string, gender string, age double, income double"),
        tables.scan(spark, as_csv(frame(asked, "id string, app_id long, dt string, amount double, outcome string")), tables.APPLICATIONS),
        frame(moves, "id string, dt string, amount double, balance double"),
        out,
        "2024-12-31",
        training.Settings(as_of="2024-12-31"),
    )
    applied = {r[0] for r in asked}
    scores = spark.read.parquet(f"{out}/prospect_scores")
    assert {r["id"] for r in scores.collect()} == {p[0] for p in people} - applied
    assert scores.where("model_score between 0 and 1 and is_extrapolated").count() == 120 - len(applied)
    assert {r["score_rank"] for r in scores.collect()} >= {1}
    written = {n: spark.read.parquet(f"{out}/{n}") for n in ("variance", "vif", "anova", "dropped_features", "coefficients", "roc", "drawdown_trend", "top_drawdowns")}
    inputs = model.stages[0].getInputCols()
    left_out = {r["feature"] for r in written["dropped_features"].collect()}
    assert left_out | set(inputs) == {r["feature"] for r in written["variance"].collect()} and not left_out & set(inputs)
    assert {r["feature"] for r in written["anova"].collect()} == set(inputs)
    assert written["top_drawdowns"].count() == 15 and written["drawdown_trend"].count() == 6 and written["roc"].count() > 2
    findings = spark.read.parquet(f"{out}/quality_report")
    assert findings.select("section").distinct().count() == 9
    metrics = {(r["section"], r["metric"], r["label"]): r["value"] for r in spark.read.parquet(f"{out}/training_metrics").collect()}
    labelled = sum(r[4] is not None for r in asked)
    assert metrics["rows", "n_train", None] + metrics["rows", "n_test", None] == labelled
    assert metrics["rows", "n_unlabelled", None] == len(asked) - labelled
    assert tables.load_model(f"{out}/model").stages[0].getInputCols() == model.stages[0].getInputCols()


def test_many_classes(spark):
    rows = spark.range(6_000).selectExpr("id as app_id", "cast(id % 1500 as string) as label")
    weighted = modeling.class_weights(rows, "label")
    assert weighted.count() == 6_000 and weighted.where("class_weight <> 1.0").isEmpty()
    split = modeling.stratified_split_exact(rows, "label", "app_id", 0.5).groupBy("label").agg(F.count_if("is_test").alias("n"))
    assert split.count() == 1500 and split.where("n <> 2").isEmpty()


def test_shares_below_a_millionth(spark):
    rows = spark.range(200_000).select(C.hash_number(F.col("id"), 1).alias("h"), C.in_share(F.col("id"), 1, 0.0001).alias("x"))
    assert 5 <= rows.where("x").count() <= 40


def test_csv_is_read_by_name(spark):
    path = scratch_path(spark, "csv-by-name")
    spark.sql("select 'TakeUp' as outcome, 'x' as more, '2024-01-02' as dt, '007' as id, 'many' as amount").write.option(
        "header", True
    ).csv(path)
    got = tables.scan_csv(spark, path, tables.APPLICATIONS)
    assert got.first().asDict() == {"outcome": "TakeUp", "more": "x", "dt": "2024-01-02", "id": "007", "amount": None}


def test_prospects_are_ranked(frame):
    train = applications(frame).where("target is not null")
    model = modeling.fit_classifier(train, ["x"], "target")
    rows = [("a", 0, 1.0), ("b", 0, 2.0), ("c", 0, 2.0), ("d", 0, None), ("e", 3, 1.0), ("f", 0, -1.0)]
    people = frame([(i, n, x, "Male", "s", "q") for i, n, x in rows], "id string, total_applications int, x double, gender string, customer_segment string, action_quadrant string")
    got = {r.id: (r.score_rank, r.is_complete) for r in modeling.score_prospects(model, people).collect()}
    assert got == {"b": (1, True), "c": (1, True), "a": (3, True), "f": (4, True), "d": (None, False)}


def test_sides_are_marked_once(frame):
    """What reads training or test rows reads a mark, and does not hash every key again."""
    asked = [("a", i, "2024-03-01", 5.0, "TakeUp" if i % 2 else "Declined") for i in range(40)]
    prepared = training.prepare(
        frame([("a", "F", 30.0, 10.0)], "id string, gender string, age double, income double"),
        frame(asked, "id string, app_id long, dt string, amount double, outcome string"),
        frame([("a", "2024-01-01", 1.0, 1.0)], "id string, dt string, amount double, balance double"),
        training.Settings(as_of="2024-12-31"),
    )
    assert prepared.train.count() + prepared.test.count() == 40
    for side in (prepared.train, prepared.test):
        assert "md5" not in side._jdf.queryExecution().optimizedPlan().toString()
