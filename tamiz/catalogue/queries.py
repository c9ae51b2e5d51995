"""The registered queries: each takes (spark, folder of parquet tables) and returns a DataFrame.

Where a query needs missing cells, they follow from another column of the same row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.columns import (
    TARGET,
    Roles,
    drop_missing_rows,
    feature_array,
    preview,
    select_except,
    standardise_types,
    table_shape,
)
from tamiz.functions.labels import class_distribution, drop_unknown_target, map_labels, unmap_labels
from tamiz.operators.balance import class_weight_table, undersample, with_class_weights
from tamiz.operators.encode import fit_factorizer
from tamiz.operators.evaluate import classification_report, confusion_matrix, multiclass_auc
from tamiz.operators.knn import KnnModel, SearchLimits, nearest_neighbours, shares, training_table, votes, winner
from tamiz.operators.missing import ImputeSpec, fit_imputer, impute_all
from tamiz.operators.rescale import fit_scaler, rescale_all
from tamiz.operators.score import attach, restore_labels, spread_probabilities
from tamiz.operators.split import random_split, stratified_split
from tamiz.operators.statistics import exact_median, feature_statistics, mode
from tamiz.operators.sweep import KnnGrid, TreeGrid, sweep_knn, sweep_tree
from tamiz.operators.tree import best_splits, fit_exact_tree, fit_mllib_tree, fit_trees, split_candidates
from tamiz.plans.preparation import Preparation, fit_fill_and_scale
from tamiz.plans.scoring import evaluate_model, score, score_stored
from tamiz.plans.training import TrainConfig, train
from tamiz.session import materialise, scratch_path
from tamiz.sources.models import save_models, save_preparation
from tamiz.sources.sinks import read_reports, write_csv, write_predictions, write_report_csv, write_reports
from tamiz.sources.tables import read_csv, read_dataset

Query = Callable[[SparkSession, str], DataFrame]

SEGMENTS = {"AUTOMOBILE": 0, "BUILDING": 1, "MACHINERY": 2}
PART_TYPES = {"ECONOMY": 0, "LARGE": 1, "MEDIUM": 2, "PROMO": 3, "SMALL": 4, "STANDARD": 5}
MORE_TYPES = {**PART_TYPES, "UNUSED": 6}
ORDER_STATES = {"F": 0, "O": 1, "P": 2}
EVENT_TYPES = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}
FIVE_TYPES = {"ECONOMY": 0, "LARGE": 1, "MEDIUM": 2, "SMALL": 3, "STANDARD": 4}
PART_FEATURES = ("p_size", "p_retailprice")
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
EMBEDDING_CLASSES = list(range(10))
# Sends even small tables through the partitioned search, with blocks and cells small enough to salt.
ALWAYS_PARTITIONED = SearchLimits(
    direct_rows=0, cell_rows=256, wide_cell_rows=256, block_train=512, block_queries=256
)
TWO_LEVELS = SearchLimits(direct_rows=0, cell_rows=64, wide_cell_rows=64, flat_pivots=4)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- scans and projections


def scan_limit(spark, folder):
    schema = {"o_orderkey": "long", "o_orderstatus": "string", "o_totalprice": "double"}
    return read_dataset(spark, f"{folder}/orders.parquet", schema, limit=10_000, key="o_orderkey")


def preview_rows(spark, folder):
    return preview(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")


def select_except_rename(spark, folder):
    out = select_except(table(spark, folder, "customer"), ["c_name"])
    out = out.withColumnRenamed("c_acctbal", "balance")
    return rounded(out.withColumn("debt", F.greatest(-F.col("balance"), F.lit(0.0))), "balance", "debt")


def standardise(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "event_type", "value")
    roles = Roles(("ts", "user_id", "value"), ("event_type",), key="event_id")
    return rounded(standardise_types(events, roles), "ts", "value")


def labelled_customers(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return drop_unknown_target(map_labels(customers, "c_mktsegment", SEGMENTS))


def label_map_drop_unknown(spark, folder):
    return rounded(labelled_customers(spark, folder), "c_acctbal").withColumnRenamed(TARGET, "target")


def inverse_label_map(spark, folder):
    back = unmap_labels(labelled_customers(spark, folder), TARGET, SEGMENTS, "segment")
    return back.select("c_custkey", F.col(TARGET).alias("target"), "segment")


def class_distribution_query(spark, folder):
    return class_distribution(table(spark, folder, "lineitem"), "l_returnflag")


def shape(spark, folder):
    return table_shape(table(spark, folder, "documents"))


def csv_round_trip(spark, folder):
    path = scratch_path(spark, "csv")
    customers = table(spark, folder, "customer")
    gaps = customers.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    write_csv(gaps, path)
    return rounded(read_csv(spark, path), "c_acctbal")


def csv_declared_types(spark, folder):
    path = scratch_path(spark, "csv")
    marked = table(spark, folder, "part").select(
        "p_partkey",
        "p_type",
        F.when(F.col("p_brand") == "Brand#7", F.lit("NA")).otherwise(F.col("p_size").cast("string")).alias("p_size"),
    )
    write_csv(marked, path)
    return read_csv(spark, path, {"p_partkey": "long", "p_type": "string", "p_size": "double"})


def csv_codes_and_long_ids(spark, folder):
    """Codes that look like numbers of Java stay text, and ids of 19 digits whole numbers."""
    path = scratch_path(spark, "csv")
    codes = table(spark, folder, "part").select(
        (F.col("p_partkey") + F.lit(1234567890000000000)).alias("id"),
        F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "D").otherwise("F")).alias("code"),
    )
    write_csv(codes, path)
    return read_csv(spark, path)


# ---------------------------------------------------------------- missing values


def events_with_gaps(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return events.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))


def parts_with_gaps(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", *PART_FEATURES)
    present = F.col("p_brand") != "Brand#7"
    return parts.select(
        "p_partkey",
        "p_type",
        F.when(present, F.col("p_brand")).alias("p_brand"),
        F.when(present, F.col("p_size").cast("double")).alias("p_size"),
        F.when(present, F.col("p_retailprice")).alias("p_retailprice"),
    )


def drop_missing(spark, folder):
    return rounded(drop_missing_rows(events_with_gaps(spark, folder), ["value"]), "value")


def impute_mean(spark, folder):
    rows = random_split(events_with_gaps(spark, folder), "event_id")
    return rounded(fit_imputer(rows, [ImputeSpec("value", "MEAN")]).transform(rows), "value")


def impute_mean_integers(spark, folder):
    """A whole-number column takes its mean as it is."""
    parts = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_brand") != "Brand#7", F.col("p_size")).alias("p_size"))
    return rounded(fit_imputer(parts, [ImputeSpec("p_size", "MEAN")], "self", None).transform(parts), "p_size")


def impute_median(spark, folder):
    rows = random_split(parts_with_gaps(spark, folder), "p_partkey").drop("p_brand", "p_type")
    specs = impute_all(PART_FEATURES, "MEDIAN")
    return rounded(fit_imputer(rows, specs).transform(rows), *PART_FEATURES)


def impute_mode(spark, folder):
    rows = random_split(parts_with_gaps(spark, folder), "p_partkey").drop("p_type", "p_retailprice")
    return rounded(fit_imputer(rows, impute_all(["p_size", "p_brand"], "MODE")).transform(rows), "p_size")


def impute_constant(spark, folder):
    rows = events_with_gaps(spark, folder)
    specs = [ImputeSpec("value", "CONSTANT", -1.0)]
    return rounded(fit_imputer(rows, specs, "self", None).transform(rows), "value")


def impute_create_category(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    rows = events.select("event_id", F.when(F.col("value") < 30, F.col("event_type")).alias("event_type"))
    return fit_imputer(rows, [ImputeSpec("event_type", "CREATE_CATEGORY")], "self", None).transform(rows)


def orders_with_gaps(spark, folder):
    orders = table(spark, folder, "orders")
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice")
    return random_split(orders.select("o_orderkey", price), "o_orderkey")


def impute_per_split(spark, folder):
    rows = orders_with_gaps(spark, folder)
    filled = fit_imputer(rows, [ImputeSpec("o_totalprice", "MEAN")], "per_split").transform(rows)
    return rounded(filled, "o_totalprice")


def impute_self(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    rows = customers.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    return rounded(fit_imputer(rows, [ImputeSpec("c_acctbal", "MEAN")], "self", None).transform(rows), "c_acctbal")


# ---------------------------------------------------------------- rescaling and statistics


def split_lines(spark, folder):
    # Lines have no key of their own: all lines of an order fall into the same part.
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *LINE_FEATURES)
    return random_split(lines, "l_orderkey")


def rescale_minmax(spark, folder):
    rows = split_lines(spark, folder)
    return rounded(fit_scaler(rows, rescale_all(LINE_FEATURES, "MINMAX")).transform(rows), *LINE_FEATURES)


def rescale_avgstd(spark, folder):
    rows = split_lines(spark, folder)
    return rounded(fit_scaler(rows, rescale_all(LINE_FEATURES, "AVGSTD")).transform(rows), *LINE_FEATURES)


def split_parts(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double"), "p_retailprice")
    return random_split(parts, "p_partkey")


def rescale_per_split(spark, folder):
    rows = split_parts(spark, folder)
    specs = {"p_size": "MINMAX", "p_retailprice": "AVGSTD"}
    return rounded(fit_scaler(rows, specs, "per_split").transform(rows), *PART_FEATURES)


def drop_zero_variance(spark, folder):
    # Constant in the dev part only: dropped, as one constant part is enough.
    rows = split_parts(spark, folder).withColumn(
        "p_unit", F.when(F.col("split") == "dev", F.lit(3.0)).otherwise(F.col("p_size"))
    )
    specs = rescale_all([*PART_FEATURES, "p_unit"], "AVGSTD")
    return rounded(fit_scaler(rows, specs, "per_split").transform(rows), *PART_FEATURES)


def impute_then_rescale(spark, folder):
    rows = random_split(parts_with_gaps(spark, folder), "p_partkey").drop("p_brand", "p_type")
    imputer, scaler = fit_fill_and_scale(
        rows,
        [ImputeSpec("p_size", "MEDIAN"), ImputeSpec("p_retailprice", "MEAN")],
        {"p_size": "MINMAX", "p_retailprice": "AVGSTD"},
    )
    return rounded(scaler.transform(imputer.transform(rows)), *PART_FEATURES)


def statistics_table(rows: DataFrame, features, digits: int = 6) -> DataFrame:
    keys = ["scope", "feature"]
    out = (
        feature_statistics(rows, features)
        .join(exact_median(rows, features), keys)
        .join(mode(rows, features, None, "double"), keys)
        .drop("scope")
    )
    return rounded(out, "mean", "std", "min", "max", "median", "mode", digits=digits)


def fit_statistics(spark, folder):
    return statistics_table(table(spark, folder, "lineitem").select(*LINE_FEATURES), LINE_FEATURES)


# ---------------------------------------------------------------- encoding, splits, balance


def factorize(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return fit_factorizer(orders, ["o_orderpriority", "o_orderstatus"], "o_orderkey").transform(orders)


def factorize_many_values(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    rows = customers.select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("c_name"), "c_nationkey"
    )
    return fit_factorizer(rows, ["c_name", "c_nationkey"], "c_custkey").transform(rows)


def split_stratified(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return stratified_split(labels, "doc_id", "quality")


def embeddings(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), F.col("label").cast("long").alias("label")
    )


def split_embeddings(spark, folder):
    return stratified_split(embeddings(spark, folder), "vec_id", "label")


def split_stratified_classes(spark, folder):
    return split_embeddings(spark, folder).drop("features")


def split_random(spark, folder):
    return random_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


def undersample_not_minority(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return undersample(customers, "c_custkey", "c_mktsegment")


def undersample_ratio(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    return undersample(labels, "doc_id", "toxic", 0.5)


def class_weights(spark, folder):
    labels = table(spark, folder, "labels").select(F.col("quality").cast("long").alias("quality"))
    return rounded(class_weight_table(labels, "quality"), "weight")


def row_weights(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    return rounded(with_class_weights(labels, "toxic"), "weight")


# ---------------------------------------------------------------- neighbours


def train_and_dev(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where(F.col("split") == "train").drop("split"), rows.where(F.col("split") == "dev").drop("split")


def embedding_neighbours(spark, folder, k, p, limits=SearchLimits()):
    train_rows, dev_rows = train_and_dev(split_embeddings(spark, folder))
    known = training_table(train_rows, lambda: F.col("features"), "vec_id", "label")
    return nearest_neighbours(known, dev_rows, k, p, "vec_id", limits)


def embedding_vote(p, weights, limits=SearchLimits()) -> Query:
    def query(spark, folder):
        found = embedding_neighbours(spark, folder, 5, p, limits)
        vote = votes("neighbours", EMBEDDING_CLASSES, 5, weights)
        return found.select("vec_id", "label", winner(vote, EMBEDDING_CLASSES).alias("predicted_value"))

    return query


def neighbour_list(spark, folder):
    found = embedding_neighbours(spark, folder, 5, 2, ALWAYS_PARTITIONED)
    each = found.select("vec_id", F.posexplode("neighbours").alias("i", "n"))
    return each.select(
        "vec_id",
        (F.col("i") + 1).cast("long").alias("rank"),
        "n.train_id",
        "n.label",
        F.round("n.distance", 6).alias("distance"),
    )


def labelled_parts(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_type", *PART_FEATURES)
    return drop_unknown_target(map_labels(parts, "p_type", PART_TYPES, "label"), "label").drop("p_type")


def part_vote(features, k, p, weights, limits=SearchLimits()) -> Query:
    def query(spark, folder):
        train_rows, dev_rows = train_and_dev(stratified_split(labelled_parts(spark, folder), "p_partkey", "label"))
        known = training_table(train_rows, features, "p_partkey", "label")
        asked = dev_rows.select("p_partkey", "label", feature_array(features).alias("features"))
        found = nearest_neighbours(known, asked, k, p, "p_partkey", limits)
        classes = sorted(PART_TYPES.values())
        vote = votes("neighbours", classes, k, weights)
        return found.select("p_partkey", "label", winner(vote, classes).alias("predicted_value"))

    return query


def knn_unscaled_epoch(spark, folder):
    """Seconds since 1970 as they are, with votes by distance."""
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "user_id")
    typed = standardise_types(events, Roles(("ts", "user_id"), ("event_type",), key="event_id"))
    mapped = drop_unknown_target(map_labels(typed, "event_type", EVENT_TYPES, "label"), "label")
    train_rows, dev_rows = train_and_dev(random_split(mapped, "event_id"))
    return vote_of_distance(train_rows, dev_rows, ("ts", "user_id"), "event_id", EVENT_TYPES)


def knn_small_scale(spark, folder):
    """Distances far below 1 decide as others do."""
    parts = labelled_parts(spark, folder)
    tiny = parts.select("p_partkey", "label", *[(F.col(c) * F.lit(1e-12)).alias(c) for c in PART_FEATURES])
    train_rows, dev_rows = train_and_dev(stratified_split(tiny, "p_partkey", "label"))
    return vote_of_distance(train_rows, dev_rows, PART_FEATURES, "p_partkey", PART_TYPES)


def vote_of_distance(train_rows, dev_rows, features, key, label_map):
    known = training_table(train_rows, features, key, "label")
    asked = dev_rows.select(key, "label", feature_array(features).alias("features"))
    classes = sorted(label_map.values())
    found = nearest_neighbours(known, asked, 5, 2, key)
    return found.select(key, "label", winner(votes("neighbours", classes, 5, "distance"), classes).alias("predicted_value"))


def embedding_predictions(spark, folder):
    found = embedding_neighbours(spark, folder, 5, 2)
    vote = found.withColumn("_v", votes("neighbours", EMBEDDING_CLASSES, 5, "distance"))
    return vote.select(
        "vec_id",
        "label",
        winner(F.col("_v"), EMBEDDING_CLASSES).alias("predicted_value"),
        shares(F.col("_v")).alias("probabilities"),
    )


def knn_probabilities(spark, folder):
    label_map = {str(c): c for c in EMBEDDING_CLASSES}
    spread = spread_probabilities(embedding_predictions(spark, folder), label_map)
    return rounded(spread, *[c for c in spread.columns if c.startswith("probability_")])


def knn_sweep(spark, folder):
    train_rows, dev_rows = train_and_dev(split_embeddings(spark, folder))
    return sweep_knn(train_rows, dev_rows, F.col("features"), EMBEDDING_CLASSES, "vec_id", "label", KnnGrid())


def report_columns(report: DataFrame) -> DataFrame:
    return rounded(report, "precision", "recall", "f1_score", "support")


def knn_sweep_report(spark, folder):
    return report_columns(knn_sweep(spark, folder).report)


def knn_sweep_best(spark, folder):
    return rounded(knn_sweep(spark, folder).best, "value")


# ---------------------------------------------------------------- evaluation


def confusion(spark, folder):
    return confusion_matrix(embedding_predictions(spark, folder), "label")


def report(spark, folder):
    return report_columns(classification_report(confusion(spark, folder)))


def auc(spark, folder):
    scored = embedding_predictions(spark, folder)
    columns = {c: f"p_{c}" for c in EMBEDDING_CLASSES}
    spread = scored.select("label", *[F.col("probabilities")[c].alias(n) for c, n in columns.items()])
    return rounded(multiclass_auc(spread, columns, "label"), "auc")


def auc_of_rows(spark, folder):
    """AUC of the three return flags on every line, with prices as scores: many distinct scores."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity", "l_discount")
    mapped = map_labels(lines, "l_returnflag", {"A": 0, "N": 1, "R": 2}, "label")
    names = {0: "l_extendedprice", 1: "l_quantity", 2: "l_discount"}
    return rounded(multiclass_auc(mapped, names, "label"), "auc")


# ---------------------------------------------------------------- trees


def tree_best_split(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    rows = labels.join(documents, "doc_id").select(
        F.lit(0).alias("node"),
        F.array(F.col("n_chars").cast("double"), F.col("doc_id").cast("double")).alias("features"),
        F.col("quality").cast("long").alias("label"),
    )
    rows = materialise(rows, "node")
    weights = {r["quality"]: r["weight"] for r in class_weight_table(rows.select(F.col("label").alias("quality")), "quality").collect()}
    found = best_splits(split_candidates(rows, sorted(weights), [weights[c] for c in sorted(weights)], 1))
    return found.select(
        F.col("feature").cast("long").alias("feature"),
        F.round("threshold", 6).alias("threshold"),
        F.round("score", 6).alias("score"),
        F.col("l_0").alias("left_0"),
        F.col("l_1").alias("left_1"),
    )


def stored_parts(spark, folder):
    return materialise(labelled_parts(spark, folder), "parts")


def tree_exact_depth2(spark, folder):
    parts = stored_parts(spark, folder)
    scored = fit_exact_tree(parts, PART_FEATURES, "label", max_depth=2).transform(parts)
    spread = spread_probabilities(scored, PART_TYPES).drop(*PART_FEATURES)
    return rounded(spread, *[c for c in spread.columns if c.startswith("probability_")])


def tree_exact_predict(spark, folder):
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    tree = fit_exact_tree(train_rows, PART_FEATURES, "label", max_depth=5)
    return tree.transform(dev_rows).select("p_partkey", "label", "predicted_value")


def coarse(parts: DataFrame) -> DataFrame:
    """Fewer prices than bins, where binned splits are exact."""
    return parts.withColumn("p_retailprice", (F.floor("p_retailprice") % 37).cast("double"))


def order_rows(spark, folder):
    """Orders as rows of two features with few values each, as many rows to a value as trees need to be alike."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("p_partkey"),
        F.col("o_orderstatus").alias("p_type"),
        (F.col("o_custkey") % 6).cast("double").alias("p_size"),
        (F.floor("o_totalprice") % 5).cast("double").alias("p_retailprice"),
    )
    return orders


def labelled_orders(spark, folder):
    mapped = map_labels(order_rows(spark, folder), "p_type", ORDER_STATES, "label").drop("p_type")
    return train_and_dev(stratified_split(materialise(mapped, "orders"), "p_partkey", "label"))


def tree_mllib_predict_orders(spark, folder):
    train_rows, dev_rows = labelled_orders(spark, folder)
    tree = fit_mllib_tree(train_rows, list(PART_FEATURES), "label", max_depth=5)
    return tree.transform(dev_rows).select("p_partkey", "label", "predicted_value")


def tree_sweep_report_orders(spark, folder):
    train_rows, dev_rows = labelled_orders(spark, folder)
    sweep = sweep_tree(train_rows, dev_rows, list(PART_FEATURES), "label", TreeGrid(), exact=False)
    return report_columns(sweep.report)


def tree_binned_sweep_orders(spark, folder):
    """The default grid grown at once, where bins hold one value each."""
    train_rows, dev_rows = labelled_orders(spark, folder)
    sweep = sweep_tree(train_rows, dev_rows, list(PART_FEATURES), "label", TreeGrid(), method="binned")
    return report_columns(sweep.report)


def tree_binned_sweep_report(spark, folder):
    """The default grid grown at once from 256 bins, on prices as they are."""
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    sweep = sweep_tree(train_rows, dev_rows, list(PART_FEATURES), "label", TreeGrid(), method="binned")
    return report_columns(sweep.report)


def tree_binned_probabilities(spark, folder):
    """Shares of unpruned leaves; the SQL is that of the exact tree, which it equals up to 4,096 prices."""
    parts = stored_parts(spark, folder)
    tree = fit_trees(parts, PART_FEATURES, "label", 4, (1,), exact=False, max_bins=4096)[1]
    spread = spread_probabilities(tree.transform(parts), PART_TYPES).drop(*PART_FEATURES)
    return rounded(spread, *[c for c in spread.columns if c.startswith("probability_")])


def tree_mllib_predict(spark, folder):
    """Prices as they are: more values than bins."""
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    tree = fit_mllib_tree(train_rows, list(PART_FEATURES), "label", max_depth=5)
    return tree.transform(dev_rows).select("p_partkey", "label", "predicted_value")


def tree_sweep_report(spark, folder):
    """The default grid of binned trees on prices as they are."""
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    sweep = sweep_tree(train_rows, dev_rows, list(PART_FEATURES), "label", TreeGrid(), exact=False)
    return report_columns(sweep.report)


def tree_exact_sweep_report(spark, folder):
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    grid = TreeGrid((1, 2), (1, 2))
    return report_columns(sweep_tree(train_rows, dev_rows, list(PART_FEATURES), "label", grid).report)


def tree_exact_sweep_default(spark, folder):
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    return report_columns(sweep_tree(train_rows, dev_rows, list(PART_FEATURES), "label", TreeGrid()).report)


def tree_probabilities_absent_class(spark, folder):
    """A class of the label map without rows has probability 0."""
    parts = stored_parts(spark, folder)
    tree = fit_exact_tree(parts, PART_FEATURES, "label", max_depth=2, classes=sorted(MORE_TYPES.values()))
    spread = spread_probabilities(tree.transform(parts), MORE_TYPES).drop(*PART_FEATURES)
    return rounded(spread, *[c for c in spread.columns if c.startswith("probability_")])


def tree_auc(spark, folder):
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    scored = fit_exact_tree(train_rows, PART_FEATURES, "label", max_depth=3).transform(dev_rows)
    columns = {c: f"p_{c}" for c in sorted(PART_TYPES.values())}
    spread = scored.select("label", *[F.col("probabilities")[c].alias(n) for c, n in columns.items()])
    return rounded(multiclass_auc(spread, columns, "label"), "auc")


def tree_scored_stored(spark, folder):
    """Both kinds of trees, stored and loaded again, score rows with and without labels."""
    parts = coarse(stored_parts(spark, folder))
    train_rows, dev_rows = train_and_dev(stratified_split(parts, "p_partkey", "label"))
    path, classes = scratch_path(spark, "trees"), sorted(PART_TYPES.values())
    models = {
        "exact": fit_exact_tree(train_rows, PART_FEATURES, "label", max_depth=3, classes=classes),
        "mllib": fit_mllib_tree(train_rows, list(PART_FEATURES), "label", max_depth=3, classes=classes),
    }
    save_preparation(spark, Preparation(PART_FEATURES, (), PART_TYPES, "p_partkey"), path)
    save_models(spark, models, "exact", path)
    rows = unmap_labels(dev_rows, "label", PART_TYPES, "p_type").drop("label")
    out = []
    for name in models:
        known = score_stored(spark, rows, path, "p_type", name=name).predictions
        unknown = score_stored(spark, rows.drop("p_type"), path, name=name).predictions
        out.append(known.select(F.lit(name).alias("model"), "p_partkey", F.col(TARGET).alias("target"), "predicted_value"))
        none = F.lit(None).cast("long").alias("target")
        out.append(unknown.select(F.lit(name).alias("model"), "p_partkey", none, "predicted_value"))
    return reduce(DataFrame.unionByName, out)


# ---------------------------------------------------------------- scoring and whole jobs


def fitted_parts(spark, folder, label_map, limits=SearchLimits()):
    """A model on the training part of the parts, fitted and stored; the rows to score; and where it lies."""
    rows = map_labels(parts_with_gaps(spark, folder).drop("p_brand"), "p_type", label_map)
    rows = random_split(rows, "p_partkey")
    train_rows, dev_rows = train_and_dev(rows)
    known = drop_unknown_target(train_rows)
    imputer, scaler = fit_fill_and_scale(
        known, impute_all(PART_FEATURES, "MEAN"), rescale_all(PART_FEATURES, "AVGSTD"), "self", None
    )
    prep = Preparation(PART_FEATURES, (), label_map, "p_partkey", (), imputer, scaler)
    prepared = materialise(prep.transform(known), "prepared")
    known = training_table(prepared, PART_FEATURES, "p_partkey")
    model = KnnModel(known, PART_FEATURES, label_map, 5, "uniform", 2, limits)
    path = scratch_path(spark, "model")
    save_preparation(spark, prep, path)
    save_models(spark, {"KNN-k:5-p:2-w:uniform": model}, "KNN-k:5-p:2-w:uniform", path)
    return dev_rows.drop(TARGET), path


def score_unlabelled(spark, folder):
    rows, path = fitted_parts(spark, folder, PART_TYPES)
    predictions = score_stored(spark, rows.drop("p_type"), path).predictions
    return rounded(predictions, *[c for c in predictions.columns if c != "p_partkey" and c != "predicted_value"])


def score_unlabelled_index(spark, folder):
    """The same with an index of cells on two levels, stored with the model and loaded for scoring."""
    rows, path = fitted_parts(spark, folder, PART_TYPES, TWO_LEVELS)
    predictions = score_stored(spark, rows.drop("p_type"), path).predictions
    return rounded(predictions, *[c for c in predictions.columns if c != "p_partkey" and c != "predicted_value"])


def score_labelled(spark, folder):
    # PROMO has no class id: such rows are scored, but have no true class.
    rows, path = fitted_parts(spark, folder, FIVE_TYPES)
    out = scratch_path(spark, "scored")
    score_stored(spark, rows, path, "p_type", out)
    stored = spark.read.parquet(f"{out}/predictions")
    return stored.select("p_partkey", F.col(TARGET).alias("target"), "predicted_value")


def score_labelled_report(spark, folder):
    rows, path = fitted_parts(spark, folder, FIVE_TYPES)
    return report_columns(score_stored(spark, rows, path, "p_type").report)


def score_refilled(spark, folder):
    """Scoring rows filled with their own means instead of those of the training rows."""
    rows = map_labels(parts_with_gaps(spark, folder).drop("p_brand"), "p_type", PART_TYPES)
    train_rows, dev_rows = train_and_dev(random_split(rows, "p_partkey"))
    known = drop_unknown_target(train_rows)
    specs = impute_all(PART_FEATURES, "MEAN")
    imputer, scaler = fit_fill_and_scale(known, specs, rescale_all(PART_FEATURES, "AVGSTD"), "self", None)
    prep = Preparation(PART_FEATURES, (), PART_TYPES, "p_partkey", (), imputer, scaler)
    table_of = training_table(materialise(prep.transform(known), "prepared"), PART_FEATURES, "p_partkey")
    model = KnnModel(table_of, PART_FEATURES, PART_TYPES, 3, "distance", 1)
    scored = score(dev_rows.drop(TARGET, "p_type"), prep, model, refill=tuple(specs)).predictions
    return scored.select("p_partkey", "predicted_value")


def scored_dataset(spark, folder):
    parts = labelled_parts(spark, folder)
    train_rows, dev_rows = train_and_dev(stratified_split(parts, "p_partkey", "label"))
    tables = training_table(train_rows, PART_FEATURES, "p_partkey", "label")
    model = KnnModel(tables, PART_FEATURES, PART_TYPES, 5, "uniform", 2)
    out = scratch_path(spark, "scored")
    scored = spread_probabilities(model.transform(dev_rows, "p_partkey"), PART_TYPES)
    write_predictions(scored.drop(*PART_FEATURES, "label"), out)
    stored = spark.read.parquet(f"{out}/predictions")
    joined = attach(dev_rows.withColumnRenamed("label", "p_type"), stored, "p_partkey")
    named = restore_labels(joined, PART_TYPES, {"predicted_value": "predicted_type", "p_type": "p_type"})
    return rounded(named, "p_retailprice", *[c for c in named.columns if c.startswith("probability_")])


def model_goodness(spark, folder):
    train_rows, dev_rows = train_and_dev(stratified_split(stored_parts(spark, folder), "p_partkey", "label"))
    known = training_table(train_rows, PART_FEATURES, "p_partkey", "label")
    knn = KnnModel(known, PART_FEATURES, PART_TYPES, 5, "uniform", 2)
    tree = fit_exact_tree(train_rows, PART_FEATURES, "label", max_depth=2)
    _, by_knn = evaluate_model(knn, dev_rows, "p_partkey", "KNN-k:5-p:2-w:uniform", "macro f1-score", "label")
    _, by_tree = evaluate_model(tree, dev_rows, "p_partkey", "DecisionTree-z:2-l:1", "macro f1-score", "label")
    return rounded(by_knn.unionByName(by_tree), "value")


def part_config(**changes) -> TrainConfig:
    roles = Roles(PART_FEATURES, target="p_type", key="p_partkey")
    return TrainConfig(roles, PART_TYPES, **changes)


def training_job_report(spark, folder):
    """The whole KNN training job; its report is read back from where the job stored it."""
    out = scratch_path(spark, "job")
    train(parts_with_gaps(spark, folder), part_config(), out)
    return report_columns(read_reports(spark, out).drop("algorithm"))


def training_job_per_split(spark, folder):
    """The same with each split filled and rescaled by its own statistics, and the dev part balanced too."""
    config = part_config(scope="per_split", balance_dev=True)
    return report_columns(train(parts_with_gaps(spark, folder), config).sweep.report)


def training_job_best_tree_orders(spark, folder):
    config = part_config(algorithm="DecisionTree", exact_tree=False, measure="macro f1-score")
    done = train(order_rows(spark, folder), replace(config, label_map=ORDER_STATES))
    return rounded(done.sweep.best, "value")


def training_job_best_tree(spark, folder):
    """The job of binned trees on parts: gaps are filled, prices have more values than bins."""
    config = part_config(algorithm="DecisionTree", exact_tree=False, measure="macro f1-score")
    return rounded(train(parts_with_gaps(spark, folder), config).sweep.best, "value")


def training_job_tree_report(spark, folder):
    """The whole tree job as it is by default, on parts with gaps: exact trees of the default grid."""
    return report_columns(train(parts_with_gaps(spark, folder), part_config(algorithm="DecisionTree")).sweep.report)


def training_job_tree_report_raw(spark, folder):
    """The same without rescaling: a price of the dev rows in the middle between two of the training rows then lies on
    the same side of the cut in every engine."""
    config = part_config(algorithm="DecisionTree", rescale={})
    return report_columns(train(parts_with_gaps(spark, folder), config).sweep.report)


def training_job_tree_report_orders(spark, folder):
    """The default job on rows of few values."""
    config = replace(part_config(algorithm="DecisionTree"), label_map=ORDER_STATES)
    return report_columns(train(order_rows(spark, folder), config).sweep.report)


def training_job_categorical(spark, folder):
    """Brands with gaps become a category of their own, and then codes."""
    roles = Roles(PART_FEATURES, ("p_brand",), target="p_type", key="p_partkey")
    impute = (*impute_all(PART_FEATURES, "MEAN"), ImputeSpec("p_brand", "CREATE_CATEGORY"))
    config = TrainConfig(roles, PART_TYPES, impute=impute)
    return report_columns(train(parts_with_gaps(spark, folder), config).sweep.report)


def score_refilled_dropped(spark, folder):
    """Rows without a size leave; prices are filled with the mean of the scored rows."""
    rows = map_labels(parts_with_gaps(spark, folder).drop("p_brand"), "p_type", PART_TYPES)
    rows = rows.withColumn("p_retailprice", F.when(F.col("p_partkey") % 5 > 0, F.col("p_retailprice")))
    train_rows, dev_rows = train_and_dev(random_split(rows, "p_partkey"))
    known = drop_unknown_target(train_rows)
    specs, scales = [ImputeSpec("p_retailprice", "MEAN")], rescale_all(PART_FEATURES, "AVGSTD")
    imputer, scaler = fit_fill_and_scale(known, specs, scales, "self", None, ("p_size",))
    prep = Preparation(PART_FEATURES, (), PART_TYPES, "p_partkey", ("p_size",), imputer, scaler)
    table_of = training_table(materialise(prep.transform(known), "prepared"), PART_FEATURES, "p_partkey")
    model = KnnModel(table_of, PART_FEATURES, PART_TYPES, 3, "distance", 1)
    scored = score(dev_rows.drop(TARGET, "p_type"), prep, model, refill=tuple(specs)).predictions
    return scored.select("p_partkey", "predicted_value")


def report_sink(spark, folder):
    out = scratch_path(spark, "reports")
    by_flag = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("model"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("long").alias("label"),
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).cast("long").alias("predicted_value"),
    )
    counts = confusion_matrix(by_flag, "label", by=["model"])
    write_reports(classification_report(counts, ["model"]), out, "rule")
    return report_columns(read_reports(spark, out))


def report_csv_again(spark, folder):
    """A second run over the same folder replaces the CSV report of the first."""
    out = scratch_path(spark, "reports")
    for bound in (0.02, 0.05):
        by_flag = table(spark, folder, "lineitem").select(
            F.col("l_returnflag").alias("model"),
            F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("long").alias("label"),
            F.when(F.col("l_discount") > bound, 1).otherwise(0).cast("long").alias("predicted_value"),
        )
        counts = confusion_matrix(by_flag, "label", by=["model"])
        write_report_csv(classification_report(counts, ["model"]), out)
    kinds = {"model": "string", "row": "string", "precision": "double", "recall": "double", "f1_score": "double", "support": "double"}
    return report_columns(read_csv(spark, f"{out}/reports_csv", kinds))


def fit_statistics_many(spark, folder):
    """Statistics of twelve features."""
    lines = table(spark, folder, "lineitem")
    many = lines.select(*[(F.col("l_quantity") + F.lit(i) * F.col("l_tax")).alias(f"f{i}") for i in range(12)])
    return statistics_table(many, [f"f{i}" for i in range(12)], 3)


def fit_statistics_268(spark, folder):
    """Moments and ranges of 268 features with gaps."""
    lines = table(spark, folder, "lineitem")
    cells = [
        F.when((F.col("l_orderkey") + i) % 11 > 0, F.col("l_quantity") * F.lit(i % 7 + 1) + F.col("l_extendedprice") / F.lit(i + 1.0)).alias(f"f{i}")
        for i in range(268)
    ]
    found = feature_statistics(lines.select(*cells), [f"f{i}" for i in range(268)]).drop("scope")
    return rounded(found, "mean", "std", "min", "max", digits=3)


QUERIES: dict[str, Query] = {
    "fit_statistics_268": fit_statistics_268,
    "csv_codes_and_long_ids": csv_codes_and_long_ids,
    "report_csv_again": report_csv_again,
    "impute_mean_integers": impute_mean_integers,
    "fit_statistics_many": fit_statistics_many,
    "knn_unscaled_epoch": knn_unscaled_epoch,
    "knn_small_scale": knn_small_scale,
    "tree_exact_sweep_default": tree_exact_sweep_default,
    "tree_probabilities_absent_class": tree_probabilities_absent_class,
    "tree_auc": tree_auc,
    "tree_scored_stored": tree_scored_stored,
    "training_job_tree_report": training_job_tree_report,
    "training_job_categorical": training_job_categorical,
    "score_refilled_dropped": score_refilled_dropped,
    "scan_limit": scan_limit,
    "preview_rows": preview_rows,
    "select_except_rename": select_except_rename,
    "standardise_types": standardise,
    "label_map_drop_unknown": label_map_drop_unknown,
    "inverse_label_map": inverse_label_map,
    "class_distribution": class_distribution_query,
    "table_shape": shape,
    "csv_round_trip": csv_round_trip,
    "csv_declared_types": csv_declared_types,
    "report_sink": report_sink,
    "drop_missing_rows": drop_missing,
    "impute_mean": impute_mean,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "impute_constant": impute_constant,
    "impute_create_category": impute_create_category,
    "impute_per_split": impute_per_split,
    "impute_self": impute_self,
    "impute_then_rescale": impute_then_rescale,
    "rescale_minmax": rescale_minmax,
    "rescale_avgstd": rescale_avgstd,
    "rescale_per_split": rescale_per_split,
    "drop_zero_variance": drop_zero_variance,
    "fit_statistics_wide": fit_statistics,
    "factorize": factorize,
    "factorize_many_values": factorize_many_values,
    "split_stratified": split_stratified,
    "split_stratified_classes": split_stratified_classes,
    "split_random": split_random,
    "undersample_not_minority": undersample_not_minority,
    "undersample_ratio": undersample_ratio,
    "class_weights_balanced": class_weights,
    "row_weights_balanced": row_weights,
    "knn_uniform_l2": embedding_vote(2, "uniform"),
    "knn_uniform_l1": embedding_vote(1, "uniform"),
    "knn_partitioned_uniform_l2": embedding_vote(2, "uniform", ALWAYS_PARTITIONED),
    "knn_neighbours": neighbour_list,
    "knn_distance_l2": part_vote(PART_FEATURES, 5, 2, "distance"),
    "knn_distance_l1": part_vote(PART_FEATURES, 5, 1, "distance"),
    "knn_partitioned_distance_l2": part_vote(PART_FEATURES, 5, 2, "distance", ALWAYS_PARTITIONED),
    "knn_two_levels_distance_l2": part_vote(PART_FEATURES, 5, 2, "distance", TWO_LEVELS),
    "knn_partitioned_distance_l1": part_vote(PART_FEATURES, 5, 1, "distance", ALWAYS_PARTITIONED),
    "knn_distance_ties": part_vote(("p_size",), 5, 2, "distance"),
    "knn_partitioned_ties": part_vote(("p_size",), 5, 1, "distance", ALWAYS_PARTITIONED),
    "knn_probabilities": knn_probabilities,
    "knn_sweep_report": knn_sweep_report,
    "knn_sweep_best": knn_sweep_best,
    "confusion_matrix": confusion,
    "classification_report": report,
    "multiclass_auc": auc,
    "multiclass_auc_rows": auc_of_rows,
    "tree_best_split": tree_best_split,
    "tree_exact_depth2": tree_exact_depth2,
    "tree_exact_predict": tree_exact_predict,
    "tree_mllib_predict": tree_mllib_predict,
    "tree_sweep_report": tree_sweep_report,
    "tree_mllib_predict_orders": tree_mllib_predict_orders,
    "tree_sweep_report_orders": tree_sweep_report_orders,
    "tree_binned_sweep_orders": tree_binned_sweep_orders,
    "tree_binned_sweep_report": tree_binned_sweep_report,
    "tree_binned_probabilities": tree_binned_probabilities,
    "tree_exact_sweep_report": tree_exact_sweep_report,
    "model_goodness": model_goodness,
    "scored_dataset": scored_dataset,
    "score_unlabelled": score_unlabelled,
    "score_unlabelled_index": score_unlabelled_index,
    "score_labelled": score_labelled,
    "score_labelled_report": score_labelled_report,
    "score_refilled": score_refilled,
    "training_job_report": training_job_report,
    "training_job_per_split": training_job_per_split,
    "training_job_best_tree": training_job_best_tree,
    "training_job_best_tree_orders": training_job_best_tree_orders,
    "training_job_tree_report_raw": training_job_tree_report_raw,
    "training_job_tree_report_orders": training_job_tree_report_orders,
}
