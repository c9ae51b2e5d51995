import datetime

import pytest
from pyspark.sql import functions as F

from tamiz.functions.columns import Roles
from tamiz.operators.missing import ImputeSpec
from tamiz.operators.sweep import KnnGrid, TreeGrid
from tamiz.plans.scoring import score, score_stored
from tamiz.plans.training import TrainConfig, train
from tamiz.session import materialise, scratch_dir
from tamiz.sources.models import load_model, load_preparation
from tamiz.sources.sinks import read_reports, write_csv, write_reports
from tamiz.sources.tables import cap_rows, read_csv, read_dataset, with_row_id
from tests.conftest import collected


def text_file(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_csv_types_and_missing_marks(spark, tmp_path):
    path = text_file(
        tmp_path,
        "petal length,n,word,flag,mixed,empty\n"
        "5.1,1,NaN,True,1,\n,2,b,False,x,NA\nNA,3,null,True,2,null\n 4.5 ,4,\"a,b\",False,3,\n",
    )
    df = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == ["double", "bigint", "string", "boolean", "string", "double"]
    assert collected(df, "n") == [
        (5.1, 1, None, True, "1", None),
        (None, 2, "b", False, "x", None),
        (None, 3, None, True, "2", None),
        (4.5, 4, "a,b", False, "3", None),
    ]


def test_csv_with_declared_types(spark, tmp_path):
    path = text_file(tmp_path, "a,b\n1,x\nn/a,y\n")
    assert collected(read_csv(spark, path, {"a": "double"}), "a") == [(None,), (1.0,)]
    bad = text_file(tmp_path, "a,b\n1,x\nsome,y\n", "bad.csv")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, bad, {"a": "double"}).collect()
    with pytest.raises(ValueError, match="unknown column types"):
        read_csv(spark, path, {"a": "decimal"})


def test_csv_quotes_and_lines(spark, rows, tmp_path):
    texts = ['say "so"', "a\nb", " NA", "x,y", "back\\slash"]
    df = rows("i long, t string", list(enumerate(texts)))
    path = write_csv(df, f"{tmp_path}/quoted")
    assert collected(read_csv(spark, path, multiline=True), "i") == list(enumerate(texts))


def test_dataset_by_name_and_cap(spark, rows):
    rows("k int, x string, other int", [(i, str(i / 2), 0) for i in range(50)], 5).createOrReplaceTempView("halves")
    df = read_dataset(spark, "halves", {"x": "double", "k": "long"}, limit=3, key="k")
    assert collected(df, "k") == [(0.0, 0), (0.5, 1), (1.0, 2)]
    assert cap_rows(df, 2).count() == 2


def test_row_ids_are_unique_and_stored(spark, rows):
    df = with_row_id(rows("x int", [(i,) for i in range(40)], 6))
    first = collected(df, "row_id")
    assert len({r[0] for r in first}) == 40 and first == collected(df, "row_id")
    with pytest.raises(ValueError, match="exists already"):
        with_row_id(df)


def test_report_sink_overwrites_its_own_part_only(spark, rows, tmp_path):
    one = rows("model string, row string, f1_score double", [("KNN-k:1-p:1-w:uniform", "0", 0.5)])
    write_reports(one, str(tmp_path), "KNN")
    write_reports(one, str(tmp_path), "DecisionTree")
    write_reports(one, str(tmp_path), "KNN")
    got = collected(read_reports(spark, str(tmp_path)).select("algorithm", "model"), "algorithm")
    assert [a for a, _ in got] == ["DecisionTree", "KNN"]


class Session:
    """What ``scratch_dir`` asks of a session."""

    def __init__(self, master, setting=None, checkpoints=None):
        self.conf, self.sparkContext, self.setting = self, self, setting
        self.master, self.applicationId, self.checkpoints = master, "app-1", checkpoints

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" and self.setting else default

    def getCheckpointDir(self):
        return self.checkpoints


def test_scratch_folder():
    assert scratch_dir(Session("yarn", "hdfs:///shared", "hdfs:///other")) == "hdfs:///shared"
    assert scratch_dir(Session("yarn", None, "hdfs:///other")) == "hdfs:///other"


def test_scratch_folder_without_setting_is_below_the_warehouse(spark):
    class Unset:
        sparkContext = Session("yarn").sparkContext

        class conf:
            @staticmethod
            def get(name, default=None):
                return {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}.get(name, default)

    assert scratch_dir(Unset()) == "hdfs:///warehouse/_scratch"


def test_stored_table_forgets_its_origin(rows):
    df = materialise(rows("x int, p string", [(1, "a"), (2, "b")]), "table", partition_by="p")
    assert collected(df, "x") == [(1, "a"), (2, "b")] and len(df.inputFiles()) == 2
    assert df.inputFiles()[0].split("://")[-1].lstrip("/").startswith(scratch_dir(df.sparkSession).split("://")[-1].lstrip("/"))


def flowers(rows, n=150):
    """Three classes, a constant column, a time, a category, and some gaps."""
    data = []
    for i in range(n):
        c = i % 3
        data.append(
            (
                i,
                c * 2.0 + (i * 7 % 10) / 10 if i % 11 else None,
                float("nan") if i % 13 == 5 else c - (i * 3 % 10) / 8,
                3.0,
                datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=i),
                ["red", "blue", None][i % 3 if i % 5 else 0],
                ["one", "two", "three", "unknown"][c if i % 50 else 3],
            )
        )
    schema = "row_id long, `petal length` double, w double, flat double, at timestamp, colour string, kind string"
    return rows(schema, data, 4)


ROLES = Roles(("petal length", "w", "flat", "at"), ("colour",), target="kind")
LABELS = {"one": 0, "two": 1, "three": 2}


@pytest.mark.parametrize("algorithm", ["KNN", "DecisionTree"])
def test_train_store_and_score(spark, rows, tmp_path, algorithm):
    df = flowers(rows)
    config = TrainConfig(ROLES, LABELS, algorithm, knn_grid=KnnGrid((1, 3)), tree_grid=TreeGrid((2, 3), (1, 2)))
    done = train(df, config, str(tmp_path))
    assert done.best_value > 0.9 and done.preparation.features == ("petal length", "w", "at", "colour")
    # 147 known rows: 30 in dev, the rest undersampled to equal classes.
    assert done.dev.count() == 30
    sizes = {r["__target__"]: r["n"] for r in done.train.groupBy("__target__").agg(F.count("*").alias("n")).collect()}
    assert len(set(sizes.values())) == 1
    stored = read_reports(spark, str(tmp_path)).where(F.col("algorithm") == algorithm).drop("algorithm")
    assert collected(stored, "model", "row") == collected(done.sweep.report, "model", "row")

    folder = f"{tmp_path}/models/{algorithm}"
    scored = score_stored(spark, df, folder, "kind", f"{tmp_path}/out")
    fresh = score(df, done.preparation, done.model, "kind")
    assert collected(scored.predictions, "row_id") == collected(fresh.predictions, "row_id")
    assert spark.read.parquet(f"{tmp_path}/out/predictions").count() == 150
    # Rows of unknown kind are scored, and not reported.
    unknown = scored.predictions.where(F.col("__target__").isNull())
    assert unknown.count() == 3 and unknown.where("predicted_value is null").count() == 0
    total = scored.report.where("row = 'weighted avg'").first()
    assert total["support"] == 147 and total["f1_score"] > 0.9
    names = [c for c in scored.predictions.columns if c.startswith("probability_")]
    assert names == [f"probability_of_value_{n}" for n in ("one", "two", "three")]

    # Every model of the sweep is stored.
    other = list(done.models)[-1]
    by_name = score_stored(spark, df, folder, "kind", name=other).predictions
    assert collected(by_name, "row_id") == collected(score(df, done.preparation, done.models[other], "kind").predictions, "row_id")
    with pytest.raises(ValueError, match="no model"):
        load_model(spark, folder, "KNN-k:99")

    unlabelled = score_stored(spark, df.drop("kind"), folder)
    assert unlabelled.report is None and unlabelled.predictions.count() == 150


def test_unseen_category_and_gap_at_scoring(spark, rows):
    df = flowers(rows)
    done = train(df, TrainConfig(ROLES, LABELS, "DecisionTree", exact_tree=False, tree_grid=TreeGrid((3,), (1,))))
    odd = rows(
        "row_id long, `petal length` double, w double, flat double, at timestamp, colour string",
        [(1, None, None, 9.0, None, "violet"), (2, 4.0, 2.0, 3.0, datetime.datetime(2024, 1, 1), None)],
    )
    scored = score(odd, done.preparation, done.model).predictions
    assert scored.where("predicted_value is null").count() == 0 and scored.count() == 2


def test_options_of_the_job(rows):
    df = flowers(rows)
    grid = KnnGrid((1,), ("uniform",), (2,))
    plain = train(df, TrainConfig(ROLES_NO_GAPS, None, knn_grid=grid, preprocess=False, sampling=None, stratify=False))
    assert plain.preparation.features == ("flat",) and plain.preparation.scaler is None
    split = train(
        df,
        TrainConfig(
            ROLES,
            LABELS,
            knn_grid=grid,
            scope="per_split",
            balance_dev=True,
            impute=(ImputeSpec("petal length", "MEDIAN"), ImputeSpec("at", "MODE")),
            rescale={"petal length": "MINMAX"},
            drop_missing=("w",),
        ),
    )
    assert split.train.where("w is null").count() == 0
    dev = split.dev.groupBy("__target__").agg(F.count("*").alias("n")).collect()
    assert len({r["n"] for r in dev}) == 1
    again = score(df.where("not isnan(w)"), split.preparation, split.model, refill=(ImputeSpec("petal length", "MEAN"),))
    assert again.predictions.count() == df.where("not isnan(w)").count()


ROLES_NO_GAPS = Roles(("flat",), target="kind")


def test_two_classes_are_sampled_by_ratio(rows):
    data = [(i, float(i % 17), "yes" if i % 8 == 0 else "no") for i in range(240)]
    df = rows("row_id long, x double, t string", data)
    config = TrainConfig(Roles(("x",), target="t"), {"no": 0, "yes": 1}, knn_grid=KnnGrid((1,), ("uniform",), (1,)))
    done = train(df, config)
    sizes = {r["__target__"]: r["n"] for r in done.train.groupBy("__target__").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 48, 1: 24}


def test_bad_options():
    for change in ({"algorithm": "SVM"}, {"measure": "f1"}, {"scope": "dev"}, {"dev_size": 1.0}):
        with pytest.raises(ValueError):
            TrainConfig(ROLES, **change)
    with pytest.raises(ValueError, match="target"):
        TrainConfig(Roles(("x",)))


def test_stored_preparation_is_equal(spark, rows, tmp_path):
    df = flowers(rows)
    done = train(df, TrainConfig(ROLES, LABELS, knn_grid=KnnGrid((1,), ("uniform",), (2,))), str(tmp_path))
    prep = load_preparation(spark, f"{tmp_path}/models/KNN")
    assert prep.features == done.preparation.features and prep.label_map == LABELS
    typed = df.withColumn("at", F.col("at").cast("double"))
    assert collected(prep.transform(typed.drop("kind")).where("row_id < 5"), "row_id") == collected(
        done.preparation.transform(typed.drop("kind")).where("row_id < 5"), "row_id"
    )
    assert load_model(spark, f"{tmp_path}/models/KNN").k == 1
