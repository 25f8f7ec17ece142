"""Registered queries: each takes (spark, folder of tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions import rules
from tillwatch.operators import (
    backtest as bt,
    evaluate as ev,
    features as ft,
    model_table as mt,
    models,
    moments,
    profile as pf,
    quality,
    subsets,
)
from tillwatch.operators.standardise import overflow_rows, standardise
from tillwatch.plans import shared
from tillwatch.schema import (
    BALANCE_COLUMNS,
    MODEL_COLUMNS,
    MONEY_COLUMNS,
    SCORE_COLUMNS,
    SCORING_PRECISION,
    SEED,
    TX_COLUMNS,
)
from tillwatch.session import shared_path
from tillwatch.sources import csv, literals, staging, tables, versions
from tillwatch.streaming import operators as st
from tillwatch.streaming import runs, seen

Query = Callable[[SparkSession, str], DataFrame]

# The source's threshold of 1,000,000 exceeds every amount in the test tables.
CASH_OUT_THRESHOLD = 300_000

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources, sinks, catalog


@query
def ingest_good_rows(spark, sf_dir):
    return csv.good_rows(csv.read_raw(spark, shared.dirty_csv(spark, sf_dir)))


@query
def ingest_reject_report(spark, sf_dir):
    return csv.reject_report(csv.read_raw(spark, shared.dirty_csv(spark, sf_dir)))


@query
def schema_report(spark, sf_dir):
    return quality.schema_report(tables.transactions(spark, sf_dir))


@query
def preview_top_n(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    return quality.preview(tx, 20, F.desc("amount"), F.asc("tx_id"))


@query
def view_score_subset(spark, sf_dir):
    tables.transactions(spark, sf_dir).createOrReplaceTempView("tillwatch_transactions")
    return spark.sql(
        f"""
        select tx_id, amount, type, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest
        from tillwatch_transactions
        where type = 'TRANSFER' or type = 'CASH_OUT' and amount > {CASH_OUT_THRESHOLD}
        """
    )


@query
def sink_roundtrip(spark, sf_dir):
    scored = _rule_scored(spark, sf_dir, rules.transfer_or_cash_out())
    path = shared_path(spark, "scored")
    staging.write_table(scored, path, ["type"], rebalance=True)
    return staging.read_table(scored, path)


@query
def sink_repeated(spark, sf_dir):
    """Scored rows written in two jobs, each run twice, and then the transfers once more, marked as reviewed."""
    scored = _rule_scored(spark, sf_dir, rules.transfer_or_cash_out())
    table = versions.VersionedTable(spark, shared_path(spark, "scored-versions"))
    for commit in ("even", "odd", "even", "odd"):
        table.append(scored.where(F.col("tx_id") % 2 == int(commit == "odd")), commit, ["type"])
    reviewed = scored.where("type = 'TRANSFER'").withColumn("prediction", F.col("prediction") + 2)
    for _ in range(2):
        table.replace(reviewed, "reviewed", ["type"])
    table.compact("merged")
    return table.read()


@query
def manual_rows(spark, sf_dir):
    """Hand-written rows in the transactions' money type, appended to the transactions."""
    typed = standardise(literals.manual_rows(spark)).select(*SCORE_COLUMNS)
    return tables.transactions(spark, sf_dir).select(*SCORE_COLUMNS).union(typed)


# --- projections and conversion


@query
def model_columns(spark, sf_dir):
    return subsets.model_columns(tables.transactions(spark, sf_dir), "tx_id")


@query
def money_decimal(spark, sf_dir):
    raw = tables.raw_transactions(spark, sf_dir)
    return standardise(raw).select("tx_id", *MONEY_COLUMNS)


@query
def money_decimal_rescale(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    return standardise(tx, SCORING_PRECISION).select("tx_id", *MONEY_COLUMNS)


@query
def money_overflow_rows(spark, sf_dir):
    raw = tables.raw_transactions(spark, sf_dir).select("tx_id", *MONEY_COLUMNS)
    return overflow_rows(raw, 7)


# --- missing values, filters


@query
def missing_raw(spark, sf_dir):
    return quality.missing_counts(csv.read_raw(spark, shared.dirty_csv(spark, sf_dir)))


@query
def missing_typed(spark, sf_dir):
    return quality.missing_counts(tables.transactions(spark, sf_dir))


@query
def null_olddest_rows(spark, sf_dir):
    return quality.null_rows(tables.transactions(spark, sf_dir), "oldbalanceDest")


@query
def null_newdest_rows(spark, sf_dir):
    return quality.null_rows(tables.transactions(spark, sf_dir), "newbalanceDest")


@query
def fill_null_balances(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    return quality.fill_balances(tx).select("tx_id", *BALANCE_COLUMNS)


@query
def fill_all_numbers(spark, sf_dir):
    return quality.fill_balances(tables.transactions(spark, sf_dir), None)


@query
def balance_presence_flag(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir).select("tx_id", "oldbalanceDest")
    return quality.presence_flag(tx, "oldbalanceDest")


@query
def score_subset_large_cashout(spark, sf_dir):
    rule = rules.transfer_or_large_cash_out(CASH_OUT_THRESHOLD)
    return subsets.score_subset(tables.transactions(spark, sf_dir), rule, "tx_id")


@query
def score_subset_transfer_cashout(spark, sf_dir):
    return subsets.score_subset(tables.transactions(spark, sf_dir), None, "tx_id")


@query
def large_flagged_count(spark, sf_dir):
    return pf.count_where(tables.transactions(spark, sf_dir), rules.large_and_flagged())


@query
def large_fraud_count(spark, sf_dir):
    return pf.count_where(tables.transactions(spark, sf_dir), rules.large_and_fraud())


@query
def large_transfer_alerts(spark, sf_dir):
    return subsets.large_transfer_alerts(tables.transactions(spark, sf_dir))


# --- aggregation and profiling


@query
def row_count(spark, sf_dir):
    return pf.row_count(tables.transactions(spark, sf_dir))


@query
def profile_raw(spark, sf_dir):
    return pf.profile(shared.staged_raw(spark, sf_dir), TX_COLUMNS)


@query
def profile_decimal(spark, sf_dir):
    return pf.profile(shared.staged_transactions(spark, sf_dir), TX_COLUMNS)


@query
def profile_by_file(spark, sf_dir):
    """The same profile from moments of each file; the first file is measured alone, the others when they come."""
    tx = shared.staged_transactions(spark, sf_dir).select(*TX_COLUMNS)
    files = sorted(tx.inputFiles())
    table = versions.VersionedTable(spark, shared_path(spark, "moments"))
    moments.refresh(table, tx.schema, files[:1])
    moments.refresh(table, tx.schema, files)
    return moments.profile(table, tx.schema, files)


@query
def profile_model_columns(spark, sf_dir):
    return pf.profile(shared.staged_transactions(spark, sf_dir), MODEL_COLUMNS)


def _coded_scores(spark, sf_dir):
    """Scored rows with type codes fit on themselves."""
    scored = _rule_scored(spark, sf_dir, rules.transfer_or_cash_out())
    coded = ft.type_indexer().fit(ft.known_types(scored)).transform(scored)
    return coded.select("amount", "type", "type_label", *BALANCE_COLUMNS, "prediction")


@query
def scored_columns(spark, sf_dir):
    return _coded_scores(spark, sf_dir)


@query
def profile_scored(spark, sf_dir):
    return pf.profile(_coded_scores(spark, sf_dir))


@query
def type_by_fraud(spark, sf_dir):
    return pf.count_by_type(tables.transactions(spark, sf_dir), "isFraud")


@query
def type_by_flag(spark, sf_dir):
    return pf.count_by_type(tables.transactions(spark, sf_dir), "isFlaggedFraud")


@query
def type_by_odd_label(spark, sf_dir):
    """Rows without a label and with another one than 0 and 1 are counted too."""
    return pf.count_by_type(tables.with_odd_labels(tables.transactions(spark, sf_dir)), "isFraud")


# --- back-test joins on a rule's prediction, which SQL can repeat


def _rule_scored(spark, sf_dir, rule, *keep):
    """Scoring rows with the flag standing in for a model's prediction."""
    tx = shared.staged_transactions(spark, sf_dir)
    subset = subsets.score_subset(tx, rule, "tx_id", "isFlaggedFraud", *keep)
    return subset.withColumn("prediction", F.col("isFlaggedFraud").cast("double")).drop(
        "isFlaggedFraud"
    )


@query
def backtest_join(spark, sf_dir):
    rule = rules.transfer_or_large_cash_out(CASH_OUT_THRESHOLD)
    scored = _rule_scored(spark, sf_dir, rule)
    return bt.backtest(shared.staged_transactions(spark, sf_dir), scored, rule=rule)


@query
def backtest_odd_labels(spark, sf_dir):
    """Missing and odd labels on one side, missing predictions on the other."""
    rule = rules.transfer_or_cash_out()
    truth = tables.with_odd_labels(shared.staged_transactions(spark, sf_dir))
    scored = _rule_scored(spark, sf_dir, rule)
    scored = scored.withColumn("prediction", F.when(F.col("tx_id") % 59 != 0, F.col("prediction")))
    return bt.backtest(truth, scored, rule=rule)


@query
def backtest_labelled(spark, sf_dir):
    rule = rules.transfer_or_large_cash_out(CASH_OUT_THRESHOLD)
    return standardise(bt.backtest_labelled(_rule_scored(spark, sf_dir, rule, "isFraud")))


@query
def backtest_join_duplicates(spark, sf_dir):
    tx = tables.with_copies(shared.staged_transactions(spark, sf_dir))
    scored = tx.withColumn("prediction", F.col("isFlaggedFraud").cast("double"))
    return bt.backtest(tx, scored, ("type", "amount", "oldbalanceDest"))


@query
def backtest_by_id(spark, sf_dir):
    rule = rules.transfer_or_cash_out()
    scored = _rule_scored(spark, sf_dir, rule)
    return bt.backtest_by_id(shared.staged_transactions(spark, sf_dir), scored, rule=rule)


@query
def predicted_fraud(spark, sf_dir):
    rule = rules.transfer_or_cash_out()
    scored = _rule_scored(spark, sf_dir, rule)
    truth = shared.staged_transactions(spark, sf_dir)
    return bt.predicted_fraud(bt.backtest(truth, scored, rule=rule))


@query
def manual_backtest(spark, sf_dir):
    """Integer-typed rows against decimal truth. All of them are transfers or cash-outs.

    The hand-written rows, and the flagged transactions as someone would type them in: without
    cents. The truth is cut to whole units as well, so that rows can match.
    """
    whole = {c: F.floor(F.col(c)) for c in MONEY_COLUMNS}
    tx = shared.staged_transactions(spark, sf_dir)
    truth = standardise(tx.withColumns(whole))
    integers = [F.col(c) if c == "type" else F.col(c).cast("int") for c in SCORE_COLUMNS]
    typed_in = truth.filter("isFlaggedFraud = 1").select(*integers)
    manual = literals.manual_rows(spark).select(*SCORE_COLUMNS)
    scored = manual.union(typed_in).withColumn("prediction", F.lit(1.0))
    return bt.backtest(truth, scored, rule=rules.transfer_or_cash_out())


# --- features


@query
def type_index(spark, sf_dir):
    tx = shared.staged_transactions(spark, sf_dir).select("tx_id", "type")
    return ft.type_indexer().fit(ft.known_types(tx)).transform(tx)


@query
def type_index_unseen(spark, sf_dir):
    tx = tables.with_unseen_type(shared.staged_transactions(spark, sf_dir).select("tx_id", "type"))
    return ft.type_indexer().fit(ft.known_types(tx)).transform(tx)


@query
def label_index(spark, sf_dir):
    tx = shared.staged_transactions(spark, sf_dir).select("tx_id", "isFraud")
    return ft.label_codes(tx).transform(tx)


@query
def type_index_skew(spark, sf_dir):
    tx = shared.staged_transactions(spark, sf_dir)
    return ft.index_skew(tx, tx.filter(rules.transfer_or_cash_out()))


@query
def manual_type_index(spark, sf_dir):
    """Hand-written rows under the training codes and under codes refit on themselves."""
    manual = literals.manual_rows(spark)
    rows = ft.known_types(shared.staged_transactions(spark, sf_dir))
    fitted = ft.type_indexer().fit(rows).setOutputCol("train_code")
    refit = ft.type_indexer().setOutputCol("refit_code").fit(manual)
    return refit.transform(fitted.transform(manual))


@query
def features(spark, sf_dir):
    tx = ft.apply_null_policy(shared.staged_transactions(spark, sf_dir), "fill")
    return ft.feature_columns(ft.fit_features(tx).transform(tx), "tx_id")


@query
def features_skip_nulls(spark, sf_dir):
    tx = shared.staged_transactions(spark, sf_dir)
    return ft.feature_columns(ft.fit_features(tx, "skip").transform(tx), "tx_id")


@query
def hash_split(spark, sf_dir):
    return ft.with_part(tables.transactions(spark, sf_dir).select("tx_id"))


@query
def random_split(spark, sf_dir):
    """The part of each id under the seeded split."""
    train, test = ft.random_split(shared.staged_transactions(spark, sf_dir).select("tx_id"), SEED)
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query
def random_split_ids(spark, sf_dir):
    """Each id of both parts of the seeded split: no row is lost or doubled."""
    return random_split(spark, sf_dir).select("tx_id")


@query
def random_split_checks(spark, sf_dir):
    """The seeded split: its parts are disjoint, whole, of the share asked for, and come out again."""
    ids = shared.staged_transactions(spark, sf_dir).select("tx_id")
    marked = []
    for _ in range(2):
        train, test = ft.random_split(ids, SEED)
        part = train.withColumn("part", F.lit("train"))
        marked.append(part.union(test.withColumn("part", F.lit("test"))))
    once, again = marked
    found = once.groupBy("tx_id").agg(F.count("*").alias("n"), F.min("part").alias("part"))
    both = found.join(again.withColumnRenamed("part", "again"), "tx_id")
    share = F.avg((F.col("part") == "train").cast("int"))
    return both.agg(
        F.count("*").alias("n_rows"),
        (F.max("n") == 1).cast("int").alias("disjoint"),
        F.min((F.col("part") == F.col("again")).cast("int")).alias("repeatable"),
        share.between(0.65, 0.75).cast("int").alias("share_ok"),
    )


# --- evaluation of the rule's prediction


def _rule_predictions(spark, sf_dir):
    return tables.transactions(spark, sf_dir).select(
        F.col("isFraud").cast("double").alias("label"),
        F.col("isFlaggedFraud").cast("double").alias("prediction"),
    )


@query
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_rule_predictions(spark, sf_dir))


@query
def class_metrics(spark, sf_dir):
    return ev.class_metrics(ev.confusion_matrix(_rule_predictions(spark, sf_dir)))


@query
def weighted_f1(spark, sf_dir):
    return ev.evaluate(_rule_predictions(spark, sf_dir))


# --- models


def _checked(scored, *columns):
    return scored.select(
        *columns,
        models.probability_ok().alias("probability_ok"),
        models.prediction_ok().alias("prediction_ok"),
    )


def _holdout_scored(spark, sf_dir, classifier):
    _, test = shared.holdout(spark, sf_dir)
    return models.score(shared.fitted(spark, sf_dir, classifier), test)


def _subset_scored(spark, sf_dir, classifier, rule, refit_index=False):
    rows = subsets.score_subset(shared.staged_transactions(spark, sf_dir), rule, "tx_id")
    model = shared.fitted(spark, sf_dir, classifier)
    scored = models.score(model, rows, refit_index=refit_index)
    return _checked(scored, "tx_id", "type", "type_label", "amount")


def _backtest(spark, sf_dir, classifier, rule):
    rows = subsets.score_subset(shared.staged_transactions(spark, sf_dir), rule, "isFraud")
    scored = models.score(shared.fitted(spark, sf_dir, classifier), bt.matchable(rows))
    return standardise(bt.backtest_labelled(scored))


@query
def lr_holdout_scores(spark, sf_dir):
    return _checked(_holdout_scored(spark, sf_dir, "lr"), "tx_id", "label")


@query
def rf_holdout_scores(spark, sf_dir):
    return _checked(_holdout_scored(spark, sf_dir, "rf"), "tx_id", "label")


@query
def lr_subset_scores(spark, sf_dir):
    rule = rules.transfer_or_large_cash_out(CASH_OUT_THRESHOLD)
    return _subset_scored(spark, sf_dir, "lr", rule)


@query
def rf_subset_scores(spark, sf_dir):
    return _subset_scored(spark, sf_dir, "rf", rules.transfer_or_cash_out())


@query
def rf_subset_scores_refit(spark, sf_dir):
    """Scored under type codes refit on the subset, as the source's programs do."""
    return _subset_scored(spark, sf_dir, "rf", rules.transfer_or_cash_out(), refit_index=True)


def _three_class_scored(spark, sf_dir, classifier):
    _, test = shared.holdout(spark, sf_dir)
    model = shared.fitted(spark, sf_dir, classifier, compat_label=True)
    n_classes = F.array_size(vector_to_array(F.col("probability"))).alias("n_classes")
    return _checked(models.score(model, test), "tx_id", "label", n_classes)


@query
def lr_three_class_scores(spark, sf_dir):
    return _three_class_scored(spark, sf_dir, "lr")


@query
def rf_three_class_scores(spark, sf_dir):
    return _three_class_scored(spark, sf_dir, "rf")


@query
def manual_scoring(spark, sf_dir):
    """Hand-written rows scored along with the transactions."""
    rows = manual_rows(spark, sf_dir)
    return _checked(models.score(shared.fitted(spark, sf_dir, "rf"), rows), *SCORE_COLUMNS)


def _evaluation(scored):
    """Figures per class, and whether each is the one of MLlib's evaluator.

    Only classes that occur as labels.
    """
    metrics = ev.class_metrics(ev.confusion_matrix(scored)).filter("n_actual > 0")
    names = {"precision": "precisionByLabel", "recall": "recallByLabel", "f1": "fMeasureByLabel"}
    flags = []
    for name, there in names.items():
        expected = F.lit(None)
        for label in (0.0, 1.0):
            evaluator = MulticlassClassificationEvaluator(metricLabel=label, metricName=there)
            found = F.lit(evaluator.evaluate(scored))
            expected = F.when(F.col("class") == label, found).otherwise(expected)
        flags.append((F.abs(F.col(name) - expected) < 1e-9).cast("int").alias(f"{name}_ok"))
    return metrics.select("*", *flags)


def _flags(df, *columns):
    """The columns, and those flags that depend on no learned value, so that SQL can repeat them."""
    return df.select(*columns, *[c for c in df.columns if c.endswith("_ok") or c in _FLAGS])


_FLAGS = ("optimal", "is_class", "same_alone")


@query
def lr_certificate(spark, sf_dir):
    """Coefficient, gradient, margin and slack of each feature over the training rows."""
    return shared.certified(spark, sf_dir)


@query
def lr_evaluation(spark, sf_dir):
    """Figures per class; probabilities are those of the fitted coefficients, and these are the optimum."""
    scored = shared.scored_holdout(spark, sf_dir, "lr")
    model = shared.fitted(spark, sf_dir, "lr").stages[-1]
    margin = mt.margin(model, vector_to_array(F.col("features")))
    off = F.abs(vector_to_array(F.col("probability"))[1] - 1 / (1 + F.exp(-margin)))
    checked = scored.groupBy(F.col("label").alias("class")).agg(
        (F.max(off) < 1e-9).cast("int").alias("probability_ok")
    )
    optimal = mt.is_optimal(shared.certified(spark, sf_dir)).first().optimal
    return _evaluation(scored).join(checked, "class").withColumn("optimal", F.lit(optimal))


@query
def lr_evaluation_checks(spark, sf_dir):
    return _flags(lr_evaluation(spark, sf_dir), "class", "n_actual")


@query
def forest_nodes(spark, sf_dir):
    """The fitted forest as a table."""
    return shared.forest_table(spark, sf_dir)


@query
def forest_leaves(spark, sf_dir):
    """Each leaf's path as a condition, with the training rows that it covers."""
    depth = shared.fitted(spark, sf_dir, "rf").stages[-1].getMaxDepth()
    return mt.forest_leaves(shared.forest_table(spark, sf_dir), depth)


def _from_table(spark, sf_dir, scored):
    """Scored rows with what the forest's table gives."""
    depth = shared.fitted(spark, sf_dir, "rf").stages[-1].getMaxDepth()
    return mt.rescored(scored, shared.forest_table(spark, sf_dir), depth)


def _same_as_table():
    off = F.abs(vector_to_array(F.col("probability"))[1] - F.col("table_probability"))
    return (off < 1e-9) & (F.col("prediction") == F.col("table_prediction"))


@query
def rf_holdout_table_scores(spark, sf_dir):
    """Probability and prediction of each test row, from the forest's table and by MLlib."""
    scored = _from_table(spark, sf_dir, shared.scored_holdout(spark, sf_dir, "rf"))
    given = vector_to_array(F.col("probability"))[1].alias("probability")
    same = _same_as_table().cast("int").alias("table_ok")
    return scored.select("tx_id", "label", given, "prediction", "table_probability", "table_prediction", same)


@query
def rf_holdout_table_checks(spark, sf_dir):
    return _flags(rf_holdout_table_scores(spark, sf_dir), "tx_id", "label")


@query
def rf_evaluation(spark, sf_dir):
    """Figures per class; every prediction is the one of the forest's table."""
    scored = shared.scored_holdout(spark, sf_dir, "rf")
    same = _from_table(spark, sf_dir, scored).groupBy(F.col("label").alias("class")).agg(
        F.min(_same_as_table().cast("int")).alias("table_ok")
    )
    return _evaluation(scored).join(same, "class")


@query
def rf_evaluation_checks(spark, sf_dir):
    return _flags(rf_evaluation(spark, sf_dir), "class", "n_actual")


def _checked_backtest(spark, sf_dir, classifier, rule):
    """Back-test rows, and whether their prediction is a class and that of the row scored alone.

    A forest's is also that of its table.
    """
    rows = _backtest(spark, sf_dir, classifier, rule)
    model = shared.fitted(spark, sf_dir, classifier)
    given = rows.withColumnRenamed("prediction", "found").drop("isFraud")
    again = models.score(model, given.distinct())
    table = []
    if classifier == "rf":
        again = _from_table(spark, sf_dir, again)
        table = [_same_as_table().cast("int").alias("table_ok")]
    again = again.select(*SCORE_COLUMNS, "found", "prediction", *table)
    same = [F.col(f"r.{c}") == F.col(f"a.{c}") for c in SCORE_COLUMNS]
    both = rows.alias("r").join(again.alias("a"), [*same, F.col("r.prediction") == F.col("a.found")])
    return both.select(
        *[F.col(f"r.{c}") for c in SCORE_COLUMNS],
        "r.isFraud",
        "r.prediction",
        F.col("r.prediction").isin(0.0, 1.0).cast("int").alias("is_class"),
        (F.col("r.prediction") == F.col("a.prediction")).cast("int").alias("same_alone"),
        *["table_ok" for _ in table],
    )


@query
def backtest_lr(spark, sf_dir):
    rule = rules.transfer_or_large_cash_out(CASH_OUT_THRESHOLD)
    return _checked_backtest(spark, sf_dir, "lr", rule)


@query
def backtest_lr_checks(spark, sf_dir):
    return _flags(backtest_lr(spark, sf_dir), *SCORE_COLUMNS, "isFraud")


@query
def backtest_rf(spark, sf_dir):
    return _checked_backtest(spark, sf_dir, "rf", rules.transfer_or_cash_out())


@query
def backtest_rf_checks(spark, sf_dir):
    return _flags(backtest_rf(spark, sf_dir), *SCORE_COLUMNS, "isFraud")


@query
def predicted_fraud_rf(spark, sf_dir):
    """The rows that the forest calls fraud, with their labels."""
    return bt.predicted_fraud(_backtest(spark, sf_dir, "rf", rules.transfer_or_cash_out()))


@query
def predicted_fraud_rf_checks(spark, sf_dir):
    """Whether the predicted frauds are exactly the positives of the back-test."""
    rows = staging.stage(_backtest(spark, sf_dir, "rf", rules.transfer_or_cash_out()), "backtest")
    found = bt.predicted_fraud(rows)
    counts = found.agg(
        F.count("*").alias("n_found"), F.count_if(F.col("prediction") != 1).alias("n_wrong")
    )
    n_positive = rows.agg(F.count_if(F.col("prediction") == 1)).first()[0]
    return counts.select(
        (F.col("n_found") == n_positive).cast("int").alias("all_positives"),
        (F.col("n_wrong") == 0).cast("int").alias("only_positives"),
    )


# --- streams


def _event_stream(spark, sf_dir, repeated=False):
    """The events as a stream of several batches."""
    folder = shared.dealt_events(spark, sf_dir, repeated=repeated)
    return tables.event_transactions(tables.read_event_files(runs.stream_session(spark), folder, 2))


@query
def stream_ingest(spark, sf_dir):
    raw = csv.read_raw_stream(runs.stream_session(spark), shared.dirty_csv(spark, sf_dir), 2)
    return runs.append_available(spark, csv.good_rows(raw), "ingest")


@query
def stream_score(spark, sf_dir):
    scored = st.score_stream(_event_stream(spark, sf_dir), shared.fitted(spark, sf_dir, "rf"))
    return runs.append_available(spark, _checked(scored, "tx_id", "type", "amount"), "score")


@query
def stream_large_transfer_alerts(spark, sf_dir):
    alerts = st.alert_stream(_event_stream(spark, sf_dir)).drop("event_time")
    return runs.append_available(spark, alerts, "alerts")


def _shown(totals):
    return totals.withColumns(
        {
            "window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
            "total_amount": F.col("total_amount").cast("double"),
        }
    )


def _windowed(spark, transactions, name):
    return runs.update_available(spark, _shown(st.hourly_totals(transactions)), name, ["window_start", "type"])


def _ordered_stream(spark, sf_dir, repeated=False):
    """The events as a stream in the order of time."""
    folder = shared.ordered_events(spark, sf_dir, repeated)
    return tables.event_transactions(tables.read_event_files(runs.stream_session(spark), folder, 1))


@query
def stream_alerts_by_window(spark, sf_dir):
    return _windowed(spark, st.alert_stream(_event_stream(spark, sf_dir)), "alert-windows")


@query
def stream_totals_by_window(spark, sf_dir):
    """Replayed in the order of time: each window is written once, when a watermark of two hours closes it."""
    totals = st.hourly_totals(_ordered_stream(spark, sf_dir), lateness="2 hours")
    return runs.append_available(spark, _shown(totals), "windows")


@query
def stream_step_totals(spark, sf_dir):
    """Files of transactions as a stream whose event time comes from the hour number."""
    raw = csv.read_raw_stream(runs.stream_session(spark), shared.dirty_csv(spark, sf_dir), 1)
    tx = st.with_event_time(standardise(csv.good_rows(raw).select("step", "type", *MONEY_COLUMNS)))
    return _windowed(spark, tx, "steps")


@query
def stream_dedup(spark, sf_dir):
    """Every 10th event comes twice; each id leaves once and is then scored. State covers two hours of events."""
    model = shared.fitted(spark, sf_dir, "rf")

    def scored(rows):
        return _checked(st.score_stream(rows, model), "tx_id", "type", "amount")

    return seen.unique_available(spark, _ordered_stream(spark, sf_dir, repeated=True), "dedup", then=scored)
