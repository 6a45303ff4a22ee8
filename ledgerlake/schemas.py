"""Table schemas of the three layers.

Fixed values: column names and types are the tables' contract.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# ---- bronze: raw text, every column STRING --------------------------------
CUSTOMER_RAW_COLUMNS = ("CustomerID", "CustomerName", "Country", "RiskCategory",
                        "KYCStatus", "Occupation", "EffectiveDate")
ACCOUNT_RAW_COLUMNS = ("AccountID", "CustomerID", "AccountType", "Currency", "OpenDate")
TRANSACTION_RAW_COLUMNS = ("TransactionID", "CustomerID", "AccountID", "TransactionDate",
                           "Amount", "TransactionType", "Channel", "DestinationCountry",
                           "IsFraud", "IsLaundered", "RiskScore")

CUSTOMER_RAW = _strings(*CUSTOMER_RAW_COLUMNS)
ACCOUNT_RAW = _strings(*ACCOUNT_RAW_COLUMNS)
TRANSACTION_RAW = _strings(*TRANSACTION_RAW_COLUMNS)

# lineage columns added to the customer load
LINEAGE = T.StructType([
    T.StructField("IngestionDate", T.TimestampType(), True),
    T.StructField("SourceFile", T.StringType(), True),
])

# ---- silver ----------------------------------------------------------------
CUSTOMER_TRACKED = ("CustomerName", "Country", "RiskCategory", "KYCStatus", "Occupation")

CUSTOMER_DIM = T.StructType([
    T.StructField("CustomerSK", T.LongType(), True),
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("CustomerName", T.StringType(), True),
    T.StructField("Country", T.StringType(), True),
    T.StructField("RiskCategory", T.StringType(), True),
    T.StructField("KYCStatus", T.StringType(), True),
    T.StructField("Occupation", T.StringType(), True),
    T.StructField("StartDate", T.DateType(), True),
    T.StructField("EndDate", T.DateType(), True),
    T.StructField("IsCurrent", T.BooleanType(), True),
])

ACCOUNT_DIM = T.StructType([
    T.StructField("AccountSK", T.LongType(), True),
    T.StructField("AccountID", T.StringType(), True),
    T.StructField("CustomerSK", T.LongType(), True),
    T.StructField("AccountType", T.StringType(), True),
    T.StructField("Currency", T.StringType(), True),
    T.StructField("OpenDate", T.DateType(), True),
])

AMOUNT_TYPE = T.DecimalType(10, 2)

TRANSACTION_FACT = T.StructType([
    T.StructField("TransactionID", T.StringType(), True),
    T.StructField("CustomerSK", T.LongType(), True),
    T.StructField("AccountSK", T.LongType(), True),
    T.StructField("TransactionDate", T.DateType(), True),
    T.StructField("Amount", AMOUNT_TYPE, True),
    T.StructField("TransactionType", T.StringType(), True),
    T.StructField("Channel", T.StringType(), True),
    T.StructField("DestinationCountry", T.StringType(), True),
    T.StructField("IsFraud", T.BooleanType(), True),
    T.StructField("IsLaundered", T.BooleanType(), True),
    T.StructField("RiskScore", T.IntegerType(), True),
])

FACT_COLUMNS = tuple(f.name for f in TRANSACTION_FACT.fields)

# ---- gold / model outputs ---------------------------------------------------
FEATURE_COLUMNS = ("TxnCount_Last_7_Days", "AvgAmount_Last_30_Days", "Amount_vs_Avg",
                   "IsForeignTransaction", "CustomerTenure")
