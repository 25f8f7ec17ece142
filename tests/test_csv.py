from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import TX_ROWS, rows
from tillwatch.schema import TX_COLUMNS, TX_SCHEMA
from tillwatch.session import shared_path
from tillwatch.sources import csv, staging

HEADER = ",".join(TX_COLUMNS)
GOOD = "1,PAYMENT,9839.64,C1231006815,170136.0,160296.36,M1979787155,0.0,0.0,0,0"
LINES = [
    GOOD,
    "2,TRANSFER,1.0E7,C1,0,0,C2,,5.5,1,0",
    "3,CASH_OUT,12.5,C1, ,0,C2,0,0,0,0",
    "4,CASH_OUT,zz,C1,0,0,C2,0,0,0,0",
    "5,CASH_OUT,12.5,C1,0,0,C2,0,0,0,0,surplus",
    "6,CASH_OUT,12.5,C1,0,0",
    "x,CASH_OUT,12.5,C1,0,0,C2,0,0,0,0",
]


@pytest.fixture
def raw(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *LINES[:4]]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEADER, *LINES[4:]]) + "\n")
    return csv.read_raw(spark, str(tmp_path))


def test_good_rows_are_typed(raw):
    good = csv.good_rows(raw)
    assert good.schema == TX_SCHEMA
    assert [r.step for r in good.orderBy("step").collect()] == [1, 2, 3]
    assert tuple(good.filter("step = 1").first()) == TX_ROWS[0]
    assert good.filter("step = 2").first().amount == 1e7
    assert good.filter("step = 2").first().oldbalanceDest is None
    assert good.filter("step = 3").first().oldbalanceOrg is None


def test_rejects_have_reason_and_text(raw):
    assert rows(csv.rejected_rows(raw)) == [
        ("malformed record", LINES[4]),
        ("malformed record", LINES[5]),
        ("unreadable amount", LINES[3]),
        ("unreadable step", LINES[6]),
    ]


@pytest.mark.parametrize("columns", [["step"], ["nameDest"], ["isFlaggedFraud"], list(TX_COLUMNS)])
def test_counts_do_not_depend_on_selected_columns(raw, columns):
    good = csv.good_rows(raw)
    assert good.count() == 3
    assert len(good.select(*columns).collect()) == 3


def test_split_once_keeps_every_row(raw):
    table = staging.stage(csv.split_once(raw), "split", ["rejected"])
    assert rows(table.groupBy("rejected").count()) == [(False, 3), (True, 4)]
    assert table.filter("not rejected and raw_line is not null").count() == 0
    assert table.filter("rejected and raw_line is null").count() == 0


def test_written_lines_read_back(spark, tx):
    path = shared_path(spark, "lines")
    csv.write_lines(tx, [F.col(c) for c in TX_COLUMNS], path)
    assert rows(csv.good_rows(csv.read_raw(spark, path))) == rows(tx)
    assert csv.reject_report(csv.read_raw(spark, path)).count() == 0


def test_wrong_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER.replace("amount", "sum") + "\n" + GOOD + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv.read_raw(spark, str(tmp_path)).collect()


def test_partitioned_sink_reads_back(spark, tx):
    path = shared_path(spark, "sink")
    staging.write_table(tx, path, ["type"], rebalance=True)
    assert rows(staging.read_table(tx, path)) == rows(tx)
    pruned = spark.read.parquet(path).filter("type = 'TRANSFER'")
    assert pruned.count() == 1


def test_staged_table_keeps_column_metadata(spark):
    from tillwatch.operators.features import BINARY_LABEL, with_label

    df = with_label(spark.createDataFrame([(0,), (1,)], "isFraud int"))
    assert staging.stage(df, "labelled").schema["label"].metadata == BINARY_LABEL


def test_shared_path_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_path(spark, "x")
    assert path != shared_path(spark, "x")
    if root:
        assert path.startswith(root)
