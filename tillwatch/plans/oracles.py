"""SQL counterparts of the registered queries, for an engine that sees the same tables.

Written from the rules, not generated from the Spark code, so that the two check each other.
Model queries have a counterpart where it does not depend on learned values.
"""

from __future__ import annotations

from tillwatch.plans.queries import CASH_OUT_THRESHOLD

# raw: money as double; tx: money as decimal(12,2).
TX = """
raw AS (
  SELECT o_orderkey AS tx_id,
         CAST(1 + o_orderkey % 743 AS INTEGER) AS step,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
              WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN'
              WHEN '5-LOW' THEN 'DEBIT' END AS "type",
         o_totalprice AS amount,
         'C' || CAST(o_custkey AS VARCHAR) AS "nameOrig",
         CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice ELSE c_acctbal END AS "oldbalanceOrg",
         CASE WHEN o_orderkey % 4 = 0 THEN 0.0 ELSE c_acctbal END AS "newbalanceOrig",
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'M' ELSE 'C' END
           || CAST(o_orderkey * 7919 % 1000 AS VARCHAR) AS "nameDest",
         CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE CAST(o_orderkey % 1000 AS DOUBLE) END
           AS "oldbalanceDest",
         CASE WHEN o_orderkey % 50 = 9 THEN NULL ELSE CAST(o_orderkey % 977 AS DOUBLE) END
           AS "newbalanceDest",
         CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 12 = 0
              THEN 1 ELSE 0 END AS INTEGER) AS "isFraud",
         CAST(CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000
              THEN 1 ELSE 0 END AS INTEGER) AS "isFlaggedFraud"
  FROM orders JOIN customer ON o_custkey = c_custkey
),
tx AS (
  SELECT tx_id, step, "type", CAST(amount AS DECIMAL(12,2)) AS amount, "nameOrig",
         CAST("oldbalanceOrg" AS DECIMAL(12,2)) AS "oldbalanceOrg",
         CAST("newbalanceOrig" AS DECIMAL(12,2)) AS "newbalanceOrig", "nameDest",
         CAST("oldbalanceDest" AS DECIMAL(12,2)) AS "oldbalanceDest",
         CAST("newbalanceDest" AS DECIMAL(12,2)) AS "newbalanceDest",
         "isFraud", "isFlaggedFraud"
  FROM raw
)
"""

# The hand-written rows.
MANUAL = """
manual(amount, "type", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest") AS (
  VALUES (205000, 'TRANSFER', 0, 205000, 205000, 0),
         (1, 'CASH_OUT', 0, 300000, 600000, 300000),
         (800000, 'TRANSFER', 500000, 0, 0, 800000),
         (5000, 'TRANSFER', 5000, 0, 5000, 5000),
         (600000, 'CASH_OUT', 1000000, 400000, 1, 1),
         (10, 'CASH_OUT', 300000, 299999, 0, 300000),
         (450000, 'TRANSFER', 1000000, 650000, 5000, 500000)
)
"""

MANUAL_MONEY = """
CAST(amount AS DECIMAL(12,2)), "type", CAST("oldbalanceOrg" AS DECIMAL(12,2)),
CAST("newbalanceOrig" AS DECIMAL(12,2)), CAST("oldbalanceDest" AS DECIMAL(12,2)),
CAST("newbalanceDest" AS DECIMAL(12,2))
"""

EVENTS = """
ev AS (
  SELECT event_id AS tx_id, ts,
         CASE event_type WHEN 'click' THEN 'TRANSFER' WHEN 'view' THEN 'CASH_OUT'
              WHEN 'purchase' THEN 'PAYMENT' WHEN 'signup' THEN 'CASH_IN'
              WHEN 'error' THEN 'DEBIT' END AS "type",
         CAST(value * 1000 AS DECIMAL(12,2)) AS amount,
         CASE WHEN event_id % 4 = 0 THEN CAST(value * 1000 AS DECIMAL(12,2))
              ELSE CAST(user_id * 100 AS DECIMAL(12,2)) END AS "oldbalanceOrg",
         CASE WHEN event_id % 4 = 0 THEN CAST(0 AS DECIMAL(12,2))
              ELSE CAST(user_id * 100 AS DECIMAL(12,2)) END AS "newbalanceOrig",
         CAST(event_id % 1000 AS DECIMAL(12,2)) AS "oldbalanceDest",
         CAST(event_id % 977 AS DECIMAL(12,2)) AS "newbalanceDest"
  FROM events
)
"""

BALANCES = '"oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"'
MONEY = f"amount, {BALANCES}"
SCORE = f'amount, "type", {BALANCES}'
ALL = (
    'step, "type", amount, "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", '
    '"oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"'
)
MONEY_NAMES = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
TEXT_NAMES = ("type", "nameOrig", "nameDest")
TX_NAMES = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
    "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud",
)

LARGE_SUBSET = f""""type" = 'TRANSFER' OR ("type" = 'CASH_OUT' AND amount > {CASH_OUT_THRESHOLD})"""
BOTH_TYPES = """"type" IN ('TRANSFER', 'CASH_OUT')"""
IN_TRAIN = (
    "CAST('0x' || substr(md5(CAST(tx_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 70"
)


def _with(*parts: str) -> str:
    """Start of a statement with the given common table expressions."""
    return "WITH " + ",".join(part.strip() for part in parts) + "\n"


def _profile(source: str, names: tuple[str, ...], prefix: str) -> str:
    branches = []
    for name in names:
        if name in TEXT_NAMES:
            row = f"""CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev,
              CAST(NULL AS DOUBLE) AS min_number, CAST(NULL AS DOUBLE) AS max_number,
              min("{name}") AS min_text, max("{name}") AS max_text"""
        else:
            row = f"""round(CAST(sum("{name}") AS DOUBLE) / count("{name}"), 4) AS mean,
              round(stddev_samp(CAST("{name}" AS DOUBLE)), 4) AS stddev,
              CAST(min("{name}") AS DOUBLE) AS min_number,
              CAST(max("{name}") AS DOUBLE) AS max_number,
              CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"""
        branches.append(
            f"""SELECT '{name}' AS column_name, count("{name}") AS n, {row} FROM {source}"""
        )
    return prefix + "\nUNION ALL ".join(branches)


def _missing(source: str, blanks: dict[str, str], prefix: str) -> str:
    return prefix + "\nUNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(*) FILTER ("{name}" IS NULL) AS n_null,
            {blanks.get(name, 'CAST(0 AS BIGINT)')} AS n_blank FROM {source}"""
        for name in MONEY_NAMES
    )


def _schema_report() -> str:
    types = {"tx_id": "bigint", "step": "int", "isFraud": "int", "isFlaggedFraud": "int"}
    types |= {name: "string" for name in TEXT_NAMES}
    types |= {name: "decimal(12,2)" for name in MONEY_NAMES}
    return _with(TX) + "\nUNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS column_name,
            '{types[name]}' AS data_type, true AS nullable, count(*) FILTER ("{name}" IS NULL) AS n_null FROM tx"""
        for i, name in enumerate(("tx_id", *TX_NAMES), start=1)
    )


# Rows the dirty CSV spoils: a bad amount, a surplus field; a blank balance is no reason to reject.
SPOILED = "(tx_id % 97 = 0 OR tx_id % 101 = 0)"
GOOD_ROWS = _with(TX) + f"""
SELECT step, "type", amount, "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
       CASE WHEN tx_id % 103 = 0 THEN NULL ELSE "oldbalanceDest" END AS "oldbalanceDest",
       "newbalanceDest", "isFraud", "isFlaggedFraud"
FROM raw WHERE NOT {SPOILED}
"""

# Scoring rows with the flag as prediction.
SCORED = f"""
scored AS (
  SELECT tx_id, CAST(amount AS DECIMAL(10,2)) AS amount, "type", {BALANCES},
         CAST("isFlaggedFraud" AS DOUBLE) AS prediction
  FROM tx WHERE {{rule}}
)
"""


def _backtest(keys: tuple[str, ...], truth: str, scored: str) -> str:
    columns = ", ".join(f't."{k}"' for k in keys)
    same = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    return f"""
SELECT {columns}, s.prediction, t."isFraud" FROM {truth} t JOIN {scored} s ON {same}
GROUP BY {columns}, s.prediction, t."isFraud"
"""


SCORE_NAMES = ("amount", "type", *MONEY_NAMES[1:])

COPIES = """
dup AS (
  SELECT * FROM tx
  UNION ALL
  SELECT * REPLACE (tx_id + 10000000 AS tx_id, 1 - "isFraud" AS "isFraud") FROM tx WHERE tx_id % 10 = 0
  UNION ALL
  SELECT * REPLACE (tx_id + 20000000 AS tx_id) FROM tx WHERE tx_id % 20 = 0
),
dup_scored AS (SELECT *, CAST("isFlaggedFraud" AS DOUBLE) AS prediction FROM dup)
"""

WHOLE = """
whole AS (
  SELECT tx_id, "type", "isFraud", "isFlaggedFraud",
         CAST(floor(amount) AS DECIMAL(12,2)) AS amount,
         CAST(floor("oldbalanceOrg") AS DECIMAL(12,2)) AS "oldbalanceOrg",
         CAST(floor("newbalanceOrig") AS DECIMAL(12,2)) AS "newbalanceOrig",
         CAST(floor("oldbalanceDest") AS DECIMAL(12,2)) AS "oldbalanceDest",
         CAST(floor("newbalanceDest") AS DECIMAL(12,2)) AS "newbalanceDest"
  FROM tx
),
typed_in AS (
  SELECT *, 1.0::DOUBLE AS prediction FROM manual
  UNION ALL
  SELECT CAST(amount AS INTEGER), "type", CAST("oldbalanceOrg" AS INTEGER),
         CAST("newbalanceOrig" AS INTEGER), CAST("oldbalanceDest" AS INTEGER),
         CAST("newbalanceDest" AS INTEGER), 1.0::DOUBLE
  FROM whole WHERE "isFlaggedFraud" = 1
)
"""


def _codes(name: str, source: str, column: str = '"type"') -> str:
    return f"""
{name} AS (
  SELECT {column} AS category,
         CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS DOUBLE)
           AS code
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}
)
"""


def _features(source: str, code: str = "code") -> str:
    values = ", ".join(
        f'CAST("{name}" AS DOUBLE) AS f{i}' for i, name in enumerate(MONEY_NAMES)
    )
    return f"""SELECT tx_id, {values}, {code} AS f5 FROM {source} JOIN codes ON "type" = category"""


FILLED = """
filled AS (
  SELECT * REPLACE (coalesce("oldbalanceDest", 0) AS "oldbalanceDest",
                    coalesce("newbalanceDest", 0) AS "newbalanceDest") FROM tx
)
"""

METRICS = """
p AS (SELECT CAST("isFraud" AS DOUBLE) AS label, CAST("isFlaggedFraud" AS DOUBLE) AS prediction FROM tx),
classes AS (SELECT label AS class FROM p UNION SELECT prediction FROM p),
totals AS (
  SELECT class,
         (SELECT count(*) FROM p WHERE label = class) AS n_actual,
         (SELECT count(*) FROM p WHERE prediction = class) AS n_predicted,
         (SELECT count(*) FROM p WHERE prediction = class AND label = class) AS n_correct
  FROM classes
),
metrics AS (
  SELECT class, n_actual, n_predicted, n_correct,
         CASE WHEN n_predicted = 0 THEN 0.0::DOUBLE ELSE n_correct / n_predicted END AS "precision",
         CASE WHEN n_actual = 0 THEN 0.0::DOUBLE ELSE n_correct / n_actual END AS recall,
         CASE WHEN n_actual + n_predicted = 0 THEN 0.0::DOUBLE
              ELSE (2 * n_correct) / (n_actual + n_predicted) END AS f1
  FROM totals
)
"""

ODD = """
odd AS (
  SELECT * REPLACE (CAST(CASE WHEN tx_id % 61 = 5 THEN NULL WHEN tx_id % 67 = 5 THEN 3
                         ELSE "isFraud" END AS INTEGER) AS "isFraud") FROM tx
)
"""


def _by_type(flag: str, source: str) -> str:
    return f"""SELECT "type", nullif(count(*) FILTER ({flag} = 0), 0) AS n_0,
       nullif(count(*) FILTER ({flag} = 1), 0) AS n_1,
       nullif(count(*) FILTER ({flag} NOT IN (0, 1)), 0) AS n_other,
       nullif(count(*) FILTER ({flag} IS NULL), 0) AS n_null FROM {source} GROUP BY "type" """


def _evaluation(more: str) -> str:
    """A figure depends on the model, that it equals the one of another evaluator does not."""
    flags = ", ".join(f'CAST(1 AS INTEGER) AS "{n}_ok"' for n in ("precision", "recall", "f1"))
    return f"""SELECT CAST("isFraud" AS DOUBLE) AS class, count(*) AS n_actual, {flags}{more}
               FROM tx WHERE NOT ({IN_TRAIN}) GROUP BY 1"""


def _checked_backtest(rule: str, more: str = "") -> str:
    """A prediction is a function of the keys, so distinct keys and label are exact."""
    whole = " AND ".join(f'"{n}" IS NOT NULL' for n in SCORE_NAMES)
    return f"""SELECT DISTINCT {SCORE}, "isFraud", CAST(1 AS INTEGER) AS is_class,
               CAST(1 AS INTEGER) AS same_alone{more} FROM tx WHERE ({rule}) AND {whole}"""


CHECKED = "CAST(1 AS INTEGER) AS probability_ok, CAST(1 AS INTEGER) AS prediction_ok"
HOLDOUT = (
    _with(TX)
    + f"""SELECT tx_id, CAST("isFraud" AS DOUBLE) AS label, {CHECKED} FROM tx WHERE NOT ({IN_TRAIN})"""
)


def _subset_scores(rule: str, codes_from: str = "tx") -> str:
    return (
        _with(TX, f"subset AS (SELECT * FROM tx WHERE {rule})", _codes("codes", codes_from))
        + f"""SELECT tx_id, "type", code AS type_label, CAST(amount AS DECIMAL(10,2)) AS amount, {CHECKED}
              FROM subset JOIN codes ON "type" = category"""
    )


# The label's codes come from the training rows.
THREE_CLASS = _with(
    TX, f"train AS (SELECT * FROM tx WHERE {IN_TRAIN})", _codes("codes", "train", '"isFraud"')
) + f"""
SELECT tx_id, code AS label, CAST(3 AS INTEGER) AS n_classes, {CHECKED}
FROM tx JOIN codes ON "isFraud" = category WHERE NOT ({IN_TRAIN})
"""


def _windows(rule: str) -> str:
    return (
        _with(EVENTS)
        + f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, "type",
               count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total_amount
        FROM ev WHERE {rule} GROUP BY ALL"""
    )


def _narrow(name: str) -> str:
    return f'TRY_CAST("{name}" AS DECIMAL(7,2))'


def _overflow(name: str) -> str:
    return f'("{name}" IS NOT NULL AND {_narrow(name)} IS NULL)'


CODED = f"""
coded AS (
  SELECT amount, "type", code AS type_label, {BALANCES}, prediction
  FROM scored JOIN codes ON "type" = category
)
"""

LARGE_TRANSFER = """"type" = 'TRANSFER' AND amount > 200000"""

ORACLES: dict[str, str] = {
    # sources, sinks, catalog
    "ingest_good_rows": GOOD_ROWS,
    "ingest_reject_report": _with(TX)
    + """SELECT CASE WHEN tx_id % 101 = 0 THEN 'malformed record' ELSE 'unreadable amount' END
           AS reject_reason, count(*) AS n_rows
         FROM raw WHERE tx_id % 97 = 0 OR tx_id % 101 = 0 GROUP BY 1""",
    "schema_report": _schema_report(),
    "preview_top_n": _with(TX) + f"SELECT tx_id, {ALL} FROM tx ORDER BY amount DESC, tx_id LIMIT 20",
    "view_score_subset": _with(TX) + f"SELECT tx_id, {SCORE} FROM tx WHERE {LARGE_SUBSET}",
    "sink_roundtrip": _with(TX, SCORED.format(rule=BOTH_TYPES)) + "SELECT * FROM scored",
    "sink_repeated": _with(TX, SCORED.format(rule=BOTH_TYPES))
    + """SELECT * REPLACE (CASE WHEN "type" = 'TRANSFER' THEN prediction + 2 ELSE prediction END AS prediction)
         FROM scored""",
    "manual_rows": _with(TX, MANUAL)
    + f"SELECT {SCORE} FROM tx UNION ALL SELECT {MANUAL_MONEY} FROM manual",
    # projections and conversion
    "model_columns": _with(TX) + f'SELECT tx_id, {SCORE}, "isFraud" FROM tx',
    "money_decimal": _with(TX) + f"SELECT tx_id, {MONEY} FROM tx",
    "money_decimal_rescale": _with(TX)
    + f"SELECT tx_id, CAST(amount AS DECIMAL(10,2)) AS amount, {BALANCES} FROM tx",
    "money_overflow_rows": _with(TX)
    + "SELECT tx_id, "
    + ", ".join(f'{_narrow(n)} AS "{n}", {_overflow(n)} AS "{n}_overflow"' for n in MONEY_NAMES)
    + " FROM raw WHERE "
    + " OR ".join(_overflow(n) for n in MONEY_NAMES),
    # missing values, filters
    "missing_raw": _missing(
        "dirty",
        {"oldbalanceDest": "count(*) FILTER (tx_id % 103 = 0)"},
        _with(
            TX,
            """dirty AS (SELECT * REPLACE (CASE WHEN tx_id % 103 = 0 THEN 0.0 ELSE "oldbalanceDest" END
               AS "oldbalanceDest") FROM raw)""",
        ),
    ),
    "missing_typed": _missing("tx", {}, _with(TX)),
    "null_olddest_rows": _with(TX) + f'SELECT tx_id, {ALL} FROM tx WHERE "oldbalanceDest" IS NULL',
    "null_newdest_rows": _with(TX) + f'SELECT tx_id, {ALL} FROM tx WHERE "newbalanceDest" IS NULL',
    "fill_null_balances": _with(TX, FILLED)
    + 'SELECT tx_id, "oldbalanceOrg", "newbalanceOrig",'
    + ' CAST("oldbalanceDest" AS DECIMAL(12,2)) AS "oldbalanceDest",'
    + ' CAST("newbalanceDest" AS DECIMAL(12,2)) AS "newbalanceDest" FROM filled',
    "fill_all_numbers": _with(TX, FILLED)
    + 'SELECT tx_id, step, "type", amount, "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",'
    + ' CAST("oldbalanceDest" AS DECIMAL(12,2)) AS "oldbalanceDest",'
    + ' CAST("newbalanceDest" AS DECIMAL(12,2)) AS "newbalanceDest",'
    + ' "isFraud", "isFlaggedFraud" FROM filled',
    "balance_presence_flag": _with(TX)
    + 'SELECT tx_id, CAST(CASE WHEN "oldbalanceDest" IS NULL THEN 0 ELSE 1 END AS INTEGER)'
    + ' AS "oldbalanceDest" FROM tx',
    "score_subset_large_cashout": _with(TX)
    + f'SELECT tx_id, CAST(amount AS DECIMAL(10,2)) AS amount, "type", {BALANCES} FROM tx'
    + f" WHERE {LARGE_SUBSET}",
    "score_subset_transfer_cashout": _with(TX)
    + f'SELECT tx_id, CAST(amount AS DECIMAL(10,2)) AS amount, "type", {BALANCES} FROM tx'
    + f" WHERE {BOTH_TYPES}",
    "large_flagged_count": _with(TX)
    + 'SELECT count(*) AS n_rows FROM tx WHERE amount > 200000 AND "isFlaggedFraud" = 1',
    "large_fraud_count": _with(TX)
    + 'SELECT count(*) AS n_rows FROM tx WHERE amount > 200000 AND "isFraud" = 1',
    "large_transfer_alerts": _with(TX) + f"SELECT tx_id, {ALL} FROM tx WHERE {LARGE_TRANSFER}",
    # aggregation and profiling
    "row_count": _with(TX) + "SELECT count(*) AS n_rows FROM tx",
    "profile_raw": _profile("raw", TX_NAMES, _with(TX)),
    "profile_decimal": _profile("tx", TX_NAMES, _with(TX)),
    "profile_by_file": _profile("tx", TX_NAMES, _with(TX)),
    "profile_model_columns": _profile("tx", (*SCORE_NAMES, "isFraud"), _with(TX)),
    "scored_columns": _with(TX, SCORED.format(rule=BOTH_TYPES), _codes("codes", "scored"), CODED)
    + "SELECT * FROM coded",
    "profile_scored": _profile(
        "coded",
        ("amount", "type", "type_label", *MONEY_NAMES[1:], "prediction"),
        _with(TX, SCORED.format(rule=BOTH_TYPES), _codes("codes", "scored"), CODED),
    ),
    "type_by_fraud": _with(TX)
    + _by_type('"isFraud"', "tx"),
    "type_by_odd_label": _with(TX, ODD) + _by_type('"isFraud"', "odd"),
    "type_by_flag": _with(TX)
    + _by_type('"isFlaggedFraud"', "tx"),
    # back-test joins
    "backtest_join": _with(TX, SCORED.format(rule=LARGE_SUBSET))
    + _backtest(SCORE_NAMES, "tx", "scored"),
    "backtest_odd_labels": _with(
        TX,
        ODD,
        SCORED.format(rule=BOTH_TYPES),
        "gaps AS (SELECT * REPLACE (CASE WHEN tx_id % 59 <> 0 THEN prediction END AS prediction) FROM scored)",
    )
    + _backtest(SCORE_NAMES, "odd", "gaps"),
    "backtest_labelled": _with(TX, SCORED.format(rule=LARGE_SUBSET))
    + _backtest(SCORE_NAMES, "tx", "scored"),
    "backtest_join_duplicates": _with(TX, COPIES)
    + _backtest(("type", "amount", "oldbalanceDest"), "dup", "dup_scored"),
    "backtest_by_id": _with(TX, SCORED.format(rule=BOTH_TYPES))
    + 'SELECT s.*, t."isFraud" FROM scored s JOIN tx t ON s.tx_id = t.tx_id',
    "predicted_fraud": _with(TX, SCORED.format(rule=BOTH_TYPES))
    + f"SELECT * FROM ({_backtest(SCORE_NAMES, 'tx', 'scored')}) WHERE prediction = 1",
    "manual_backtest": _with(TX, MANUAL, WHOLE) + _backtest(SCORE_NAMES, "whole", "typed_in"),
    # features
    "type_index": _with(TX, _codes("codes", "tx"))
    + 'SELECT tx_id, "type", code AS type_label FROM tx JOIN codes ON "type" = category',
    "type_index_unseen": _with(
        TX,
        _codes("codes", "tx"),
        """unseen AS (SELECT tx_id, CASE WHEN tx_id % 500 = 1 THEN 'REFUND' ELSE "type" END AS "type"
           FROM tx)""",
    )
    + """SELECT tx_id, "type", coalesce(code, (SELECT CAST(count(*) AS DOUBLE) FROM codes)) AS type_label
         FROM unseen LEFT JOIN codes ON "type" = category""",
    "label_index": _with(TX, _codes("codes", "tx", '"isFraud"'))
    + 'SELECT tx_id, "isFraud", code AS label FROM tx JOIN codes ON "isFraud" = category',
    "type_index_skew": _with(
        TX,
        f"subset AS (SELECT * FROM tx WHERE {BOTH_TYPES})",
        _codes("trained", "tx"),
        _codes("refit", "subset"),
    )
    + """SELECT "type", trained.code AS train_code, refit.code AS refit_code, count(*) AS n_rows
         FROM subset JOIN trained ON "type" = trained.category JOIN refit ON "type" = refit.category
         GROUP BY 1, 2, 3""",
    "manual_type_index": _with(TX, MANUAL, _codes("trained", "tx"), _codes("refit", "manual"))
    + """SELECT manual.*, trained.code AS train_code, refit.code AS refit_code
         FROM manual JOIN trained ON "type" = trained.category
         JOIN refit ON "type" = refit.category""",
    "features": _with(TX, FILLED, _codes("codes", "tx")) + _features("filled"),
    "features_skip_nulls": _with(TX, _codes("codes", "tx"))
    + _features("tx")
    + ' WHERE "oldbalanceDest" IS NOT NULL AND "newbalanceDest" IS NOT NULL',
    "hash_split": _with(TX)
    + f"SELECT tx_id, CASE WHEN {IN_TRAIN} THEN 'train' ELSE 'test' END AS part FROM tx",
    "random_split_ids": _with(TX) + "SELECT tx_id FROM tx",
    "random_split_checks": _with(TX)
    + """SELECT count(*) AS n_rows, CAST(1 AS INTEGER) AS disjoint, CAST(1 AS INTEGER) AS repeatable,
                CAST(1 AS INTEGER) AS share_ok FROM tx""",
    # evaluation
    "confusion_matrix": _with(TX, METRICS)
    + "SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2",
    "class_metrics": _with(TX, METRICS) + "SELECT * FROM metrics",
    "weighted_f1": _with(TX, METRICS)
    + """SELECT CAST(sum(n_actual) AS BIGINT) AS n_rows,
                sum(n_correct) / sum(n_actual) AS accuracy,
                sum(n_actual * f1) / sum(n_actual) AS weighted_f1,
                sum(n_actual * "precision") / sum(n_actual) AS weighted_precision,
                sum(n_actual * recall) / sum(n_actual) AS weighted_recall
         FROM metrics""",
    # models: what does not depend on learned values
    "lr_holdout_scores": HOLDOUT,
    "rf_holdout_scores": HOLDOUT,
    "lr_subset_scores": _subset_scores(LARGE_SUBSET),
    "rf_subset_scores": _subset_scores(BOTH_TYPES),
    "rf_subset_scores_refit": _subset_scores(BOTH_TYPES, "subset"),
    "lr_three_class_scores": THREE_CLASS,
    "rf_three_class_scores": THREE_CLASS,
    "manual_scoring": _with(TX, FILLED, MANUAL)
    + f"""SELECT amount, "type", "oldbalanceOrg", "newbalanceOrig",
                 CAST("oldbalanceDest" AS DECIMAL(12,2)) AS "oldbalanceDest",
                 CAST("newbalanceDest" AS DECIMAL(12,2)) AS "newbalanceDest", {CHECKED} FROM filled
          UNION ALL
          SELECT {MANUAL_MONEY}, {CHECKED} FROM manual""",
    "lr_evaluation_checks": _with(TX)
    + _evaluation(", CAST(1 AS INTEGER) AS probability_ok, CAST(1 AS INTEGER) AS optimal"),
    "rf_evaluation_checks": _with(TX) + _evaluation(", CAST(1 AS INTEGER) AS table_ok"),
    "rf_holdout_table_checks": _with(TX)
    + f"""SELECT tx_id, CAST("isFraud" AS DOUBLE) AS label, CAST(1 AS INTEGER) AS table_ok
          FROM tx WHERE NOT ({IN_TRAIN})""",
    "backtest_lr_checks": _with(TX) + _checked_backtest(LARGE_SUBSET),
    "backtest_rf_checks": _with(TX) + _checked_backtest(BOTH_TYPES, ", CAST(1 AS INTEGER) AS table_ok"),
    "predicted_fraud_rf_checks": _with(TX)
    + """SELECT CAST(count(*) > 0 AS INTEGER) AS all_positives, CAST(count(*) > 0 AS INTEGER) AS only_positives
         FROM tx""",
    # streams, against the batch result
    "stream_ingest": GOOD_ROWS,
    "stream_score": _with(EVENTS) + f'SELECT tx_id, "type", amount, {CHECKED} FROM ev',
    "stream_large_transfer_alerts": _with(EVENTS)
    + f"SELECT tx_id, {SCORE} FROM ev WHERE {LARGE_TRANSFER}",
    "stream_alerts_by_window": _windows(LARGE_TRANSFER),
    "stream_totals_by_window": _windows("true"),
    "stream_step_totals": _with(TX)
    + f"""SELECT strftime(TIMESTAMP '2024-01-01' + to_hours(step - 1), '%Y-%m-%d %H:%M:%S') AS window_start,
                 "type", count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS total_amount
          FROM tx WHERE NOT {SPOILED} GROUP BY ALL""",
    "stream_dedup": _with(EVENTS) + f'SELECT tx_id, "type", amount, {CHECKED} FROM ev',
}
