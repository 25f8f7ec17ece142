"""The whole batch program on a CSV of transactions, and its streaming twin.

The CSV is scanned once: typing, reject split and the raw missing counts all happen while the
rows are written as a table. Everything after reads columns of that table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwatch.functions import rules
from tillwatch.functions.money import is_blank
from tillwatch.operators import backtest as bt
from tillwatch.operators import evaluate as ev
from tillwatch.operators import features as ft
from tillwatch.operators import models, profile, quality, subsets
from tillwatch.operators.standardise import standardise
from tillwatch.schema import MONEY_COLUMNS, SCORE_COLUMNS, SEED, TX_COLUMNS
from tillwatch.session import child_session, shared_path
from tillwatch.sources import csv, literals, staging
from tillwatch.streaming import operators as st
from tillwatch.streaming import runs


@dataclass
class Ingested:
    good: DataFrame
    rejects: DataFrame
    missing_raw: DataFrame
    path: str


def ingest(spark: SparkSession, csv_path: str) -> Ingested:
    """Write good and rejected rows in one scan, counting raw NULL and blank money on the way.

    The observed write has a session of its own: in a session that has observed a frame, Spark
    cannot ship a forest with a training summary to its tasks. Its tasks write good and rejected
    rows side by side instead of sorting them apart.
    """
    counts = {}
    for c in MONEY_COLUMNS:
        counts[f"null_{c}"] = F.count_if(F.col(c).isNull())
        counts[f"blank_{c}"] = F.count_if(is_blank(F.col(c)))
    seen = Observation("raw money")
    session = child_session(spark)
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", 2)
    raw = csv.read_raw(session, csv_path)
    observed = raw.observe(seen, *[v.alias(k) for k, v in counts.items()])
    rows = csv.split_once(observed)
    path = shared_path(spark, "ingested")
    staging.write_table(rows, path, ["rejected"])
    table = spark.read.schema(rows.schema).parquet(path)
    found = seen.get
    missing = [(c, found[f"null_{c}"], found[f"blank_{c}"]) for c in MONEY_COLUMNS]
    return Ingested(
        good=table.filter(~F.col("rejected")).select(*TX_COLUMNS),
        rejects=table.filter("rejected").select(csv.REASON, "raw_line"),
        missing_raw=spark.createDataFrame(
            missing, "column_name string, n_null bigint, n_blank bigint"
        ),
        path=path,
    )


@dataclass
class Outcome:
    """Reports by name, in the order the program makes them, and the trained model.

    Reports read tables that the run staged; ``close``, or the end of a ``with``, removes those.
    """

    model: PipelineModel
    reports: dict[str, DataFrame] = field(default_factory=dict)
    null_policy: str = "fill"
    staged: list[str] = field(default_factory=list)

    def close(self) -> None:
        spark = SparkSession.active()
        while self.staged:
            staging.remove(spark, self.staged.pop())

    def __enter__(self) -> Outcome:
        return self

    def __exit__(self, *error) -> None:
        self.close()


def default_rule(classifier: str) -> Column:
    """The forest scores all transfers and cash-outs, the regression only large cash-outs."""
    if classifier == "rf":
        return rules.transfer_or_cash_out()
    return rules.transfer_or_large_cash_out()


def run(
    spark: SparkSession,
    csv_path: str,
    classifier: str = "rf",
    rule: Column | None = None,
    null_policy: str = "fill",
    compat_label: bool = False,
    refit_index: bool = False,
    seeded_split: bool = False,
) -> Outcome:
    """Ingest, check, profile, train, evaluate, score the subset, back-test, score by hand.

    Rows without an amount, a sender's balance or a label stop the training unless the policy is
    ``skip``; the reports of incomplete and unlabelled rows tell how many a policy concerns.
    The last three options repeat choices of the original programs: a third label class, type
    codes refit on the scoring rows, and a seeded random split.
    """
    rows = ingest(spark, csv_path)
    staged = [rows.path]

    def stage(df: DataFrame, name: str) -> DataFrame:
        staged.append(shared_path(spark, name))
        staging.write_table(df, staged[-1])
        return staging.read_table(df, staged[-1])

    # Decimals and the split are made once; every report and the training read them from here.
    marked = stage(ft.with_part(standardise(rows.good)), "standardised")
    tx = marked.drop("part")
    train, test = ft.random_split(tx, SEED) if seeded_split else ft.parts(marked)
    model = models.train(train, classifier, null_policy, compat_label, codes_from=tx)
    # What has no label cannot be evaluated.
    scored_test = models.score(model, test.filter("isFraud IS NOT NULL"), null_policy)
    # A handful of rows that three reports start from.
    confusion = stage(ev.confusion_matrix(scored_test), "confusion")
    metrics = ev.class_metrics(confusion)

    rule = default_rule(classifier) if rule is None else rule
    subset = subsets.score_subset(tx, rule, "isFraud")
    subset = subset.withColumn("complete", quality.complete(SCORE_COLUMNS))
    scored = models.score(model, subset, null_policy, refit_index).select(
        *SCORE_COLUMNS, "type_label", "prediction", "isFraud", "complete"
    )
    # Scored rows are read four times; as a table the model runs over them once.
    scored = stage(scored, "scored")
    truth_and_prediction = standardise(bt.backtest_labelled(scored.filter("complete")))
    by_hand = models.score(model, literals.manual_rows(spark), null_policy, refit_index)
    return Outcome(
        model,
        {
            "schema": quality.schema_report(rows.good),
            "rejects": rows.rejects.groupBy(csv.REASON).agg(F.count("*").alias("n_rows")),
            "row count": profile.row_count(rows.good),
            "missing raw": rows.missing_raw,
            "profile raw": profile.profile(rows.good),
            "missing typed": quality.missing_counts(tx),
            "incomplete rows": profile.count_where(tx, ~quality.complete()),
            "unlabelled rows": profile.count_where(tx, F.col("isFraud").isNull()),
            "unknown types": ft.unknown_types(tx),
            "profile decimal": profile.profile(tx),
            "large transactions": profile.large_transaction_counts(tx),
            "types by fraud": profile.count_by_type(tx, "isFraud"),
            "types by flag": profile.count_by_type(tx, "isFlaggedFraud"),
            "rows without old recipient balance": quality.null_rows(tx, "oldbalanceDest"),
            "rows without new recipient balance": quality.null_rows(tx, "newbalanceDest"),
            "large transfers": subsets.large_transfer_alerts(tx),
            "confusion": confusion,
            "class metrics": metrics,
            "summary": ev.summary_metrics(metrics),
            "code skew": ft.index_skew(tx, scored),
            "profile scored": profile.profile(scored.drop("isFraud", "complete")),
            "back-test": truth_and_prediction,
            "predicted fraud": bt.predicted_fraud(truth_and_prediction),
            "by hand": by_hand.select(*SCORE_COLUMNS, "prediction"),
            "by hand back-test": bt.backtest(tx, by_hand, few_scored=True),
        },
        null_policy,
        staged,
    )


def watch(
    spark: SparkSession,
    csv_folder: str,
    model: PipelineModel,
    out: str,
    null_policy: str = "fill",
    **trigger,
) -> StreamingQuery:
    """Score arriving CSV files, raise alerts on large transfers, and keep the rejects.

    Each batch of files is read once and written below ``out``, a folder all executors share, to
    ``scored``, ``alerts``, ``rejects``, and ``unscored`` for rows that lack what scoring needs under
    the model's ``null_policy``, which must not stop the stream. Rows are written as they came: what
    is filled in for scoring stays out of the output. A batch that is repeated after a failure replaces its
    own folders, and a restart under the same ``out`` goes on where the last run stopped.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = csv.split_once(batch).persist(StorageLevel.MEMORY_AND_DISK)
        good = standardise(rows.filter(~F.col("rejected")).select(*TX_COLUMNS))
        given = good.withColumn("given", F.struct(*TX_COLUMNS))
        filled = ft.apply_null_policy(given, null_policy)
        scorable = quality.complete()
        scored = st.score_stream(filled.filter(scorable), model, null_policy)
        written = {
            "scored": scored.select("given.*", "prediction"),
            "unscored": filled.filter(~scorable).select("given.*"),
            "alerts": st.alert_stream(good),
            "rejects": rows.filter("rejected").select(csv.REASON, "raw_line"),
        }
        try:
            for name, df in written.items():
                df.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    raw = csv.read_raw_stream(runs.stream_session(spark), csv_folder)
    return runs.start_batches(raw, write_batch, f"{out}/_checkpoint", **trigger)


def save_reports(outcome: Outcome, path: str) -> None:
    """Write every report as parquet, and the model."""
    for name, report in outcome.reports.items():
        report.write.mode("errorifexists").parquet(report_path(path, name))
    models.save(outcome.model, f"{path}/model", outcome.null_policy)


def report_path(path: str, name: str) -> str:
    return f"{path}/{name.replace(' ', '_')}"
