"""The one fact table of the engine: mobile-money transactions.

Column names, the spelling ``oldbalanceOrg`` included, are fixed values of the data set.
"""

from __future__ import annotations

from pyspark.sql import types as T

TX_SCHEMA = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

TX_COLUMNS = tuple(TX_SCHEMA.fieldNames())

# The domain of ``type``.
TX_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")

BALANCE_COLUMNS = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
MONEY_COLUMNS = ("amount", *BALANCE_COLUMNS)

# Column order of the projections the models and the back-test are built on.
SCORE_COLUMNS = ("amount", "type", *BALANCE_COLUMNS)
MODEL_COLUMNS = (*SCORE_COLUMNS, "isFraud")

# Order of the model's feature vector.
FEATURE_COLUMNS = (*MONEY_COLUMNS, "type_label")

# (precision, scale) per money column: first standardisation, and the one before scoring.
MONEY_PRECISION = {c: (12, 2) for c in MONEY_COLUMNS}
SCORING_PRECISION = {**MONEY_PRECISION, "amount": (10, 2)}

# Fixed values of the business rules.
LARGE_TRANSFER = 200_000
LARGE_CASH_OUT = 1_000_000
TRAIN_PERCENT = 70
SEED = 5043
