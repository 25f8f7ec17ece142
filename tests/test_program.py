from __future__ import annotations

import pytest

from tests.conftest import rows
from tillwatch import __main__ as cli
from tillwatch.functions import rules
from tillwatch.plans import program, shared
from tillwatch.session import shared_path


@pytest.fixture(scope="module")
def csv_path(spark, sf_dir):
    return shared.dirty_csv(spark, sf_dir)


@pytest.fixture(scope="module")
def outcome(spark, csv_path):
    return program.run(spark, csv_path, "rf")


def test_ingest_counts_every_line_once(spark, csv_path, sf_dir):
    rows_in = shared.staged_transactions(spark, sf_dir).count()
    ingested = program.ingest(spark, csv_path)
    assert ingested.good.count() + ingested.rejects.count() == rows_in
    missing = {r.column_name: (r.n_null, r.n_blank) for r in ingested.missing_raw.collect()}
    expected = {
        r.column_name: (r.n_null, r.n_blank)
        for r in program.quality.missing_counts(program.csv.read_raw(spark, csv_path)).collect()
    }
    assert missing == expected


def test_reports(outcome):
    summary = outcome.reports["summary"].first()
    assert 0.9 < summary.weighted_f1 <= 1
    assert outcome.reports["by hand"].count() == 7
    scored = outcome.reports["profile scored"].filter("column_name = 'prediction'").first()
    subset = outcome.reports["code skew"].groupBy().sum("n_rows").first()[0]
    assert scored.n == subset


def test_backtest_equals_the_join(spark, outcome, csv_path):
    """The fused back-test of the program against the join on values it stands for."""
    from tillwatch.operators import backtest as bt
    from tillwatch.operators import models, subsets
    from tillwatch.operators.standardise import standardise

    tx = standardise(program.ingest(spark, csv_path).good)
    subset = subsets.score_subset(tx, rules.transfer_or_cash_out())
    scored = models.score(outcome.model, subset)
    assert rows(outcome.reports["back-test"]) == rows(
        bt.backtest(tx, scored).select(outcome.reports["back-test"].columns)
    )


def test_options_of_the_original_programs(spark, csv_path):
    result = program.run(
        spark,
        csv_path,
        "lr",
        rule=rules.transfer_or_large_cash_out(300_000),
        compat_label=True,
        refit_index=True,
        seeded_split=True,
    )
    assert result.model.stages[-1].numClasses == 3
    codes = result.reports["profile scored"].filter("column_name = 'type_label'").first()
    assert (codes.min_number, codes.max_number) == (0.0, 1.0)


def test_null_amounts_need_a_policy(spark, sf_dir):
    from pyspark.sql import functions as F

    from tillwatch.sources import csv, tables

    raw = tables.raw_transactions(spark, sf_dir)
    path = shared_path(spark, "null-amounts")
    cells = {c: F.col(c) for c in program.TX_COLUMNS}
    cells["amount"] = F.when(F.col("tx_id") % 10 != 0, F.col("amount"))
    csv.write_lines(raw, list(cells.values()), path)
    with pytest.raises(Exception, match="null"):
        program.run(spark, path, "lr")
    outcome = program.run(spark, path, "lr", null_policy="skip")
    # Every tenth row has no amount; of every fifty, two others lack a recipient balance.
    n = raw.count()
    assert outcome.reports["incomplete rows"].first().n_rows == n // 10 + 2 * (n // 50)
    assert outcome.reports["row count"].first().n_rows == n


def test_rows_without_a_label(spark, sf_dir):
    from pyspark.sql import functions as F

    from tillwatch.sources import csv, tables

    raw = tables.raw_transactions(spark, sf_dir)
    path = shared_path(spark, "null-labels")
    cells = {c: F.col(c) for c in program.TX_COLUMNS}
    cells["isFraud"] = F.when(F.col("tx_id") % 10 != 0, F.col("isFraud"))
    csv.write_lines(raw, list(cells.values()), path)
    with program.run(spark, path, "lr", null_policy="skip") as outcome:
        missing = raw.count() // 10
        assert outcome.reports["unlabelled rows"].first().n_rows == missing
        by_type = outcome.reports["types by fraud"]
        assert by_type.agg(F.sum("n_null")).first()[0] == missing
    with program.run(spark, path, "lr", compat_label=True) as outcome:
        assert outcome.model.stages[-1].numClasses == 3


def test_staged_tables_have_an_end(spark, csv_path):
    from tillwatch.sources import staging

    with program.run(spark, csv_path, "lr") as outcome:
        paths = list(outcome.staged)
        assert len(paths) == 4 and all(staging.is_folder(spark, p) for p in paths)
    for path in paths:
        with pytest.raises(Exception, match="does not exist|FileNotFound"):
            staging.is_folder(spark, path)


def test_watch_writes_rows_as_they_came(spark, csv_path, outcome, sf_dir):
    from tillwatch.streaming import runs

    out = shared_path(spark, "watch-nulls")
    runs.finish(program.watch(spark, csv_path, outcome.model, out))
    good = program.standardise(program.csv.good_rows(program.csv.read_raw(spark, csv_path)))
    nulls = good.filter("oldbalanceDest IS NULL").count()
    assert nulls > 0
    assert spark.read.parquet(f"{out}/scored").filter("oldbalanceDest IS NULL").count() == nulls


def test_changed_tables_are_seen(spark, sf_dir, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    for table in shared.SOURCES:
        shutil.copyfile(f"{sf_dir}/{table}.parquet", f"{tmp_path}/{table}.parquet")
    folder = str(tmp_path)
    before = shared.staged_transactions(spark, folder).count()
    assert shared.staged_transactions(spark, folder).count() == before
    orders = pq.read_table(f"{sf_dir}/orders.parquet")
    pq.write_table(orders.slice(0, before // 2), f"{tmp_path}/orders.parquet")
    spark.catalog.clearCache()
    assert shared.staged_transactions(spark, folder).count() == before // 2


def test_command_line(spark, csv_path, capsys, tmp_path):
    out = shared_path(spark, "cli")
    cli.main(["batch", csv_path, "--classifier", "lr", "--out", out, "--rows", "3"])
    printed = capsys.readouterr().out
    assert "class metrics" in printed and "predicted fraud" in printed
    assert spark.read.parquet(f"{out}/back-test").columns[-1] == "isFraud"
    stream_out = shared_path(spark, "cli-stream")
    cli.main(["stream", csv_path, "--model", f"{out}/model", "--out", stream_out])
    assert spark.read.parquet(f"{stream_out}/scored").count() > 0
