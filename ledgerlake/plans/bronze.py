"""Bronze job: land CSV folders into parquet tables, each file exactly once.

Customers get lineage columns: ``IngestionDate`` (the micro-batch time, one
value per load) and ``SourceFile`` (the file each row came from).  Accounts
and transactions are loaded as they are, like the reference does.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ACCOUNT_RAW, CUSTOMER_RAW, TRANSACTION_RAW
from ..streaming.incremental import load_incremental, quarantined


@dataclass
class BronzeLayer:
    customer_raw: DataFrame
    account_raw: DataFrame
    transaction_raw: DataFrame
    quarantine: DataFrame | None = None  # (TableName, RawFile, RawLine) of the malformed lines


# table name -> (schema, lineage columns)
BRONZE_TABLES = {
    "customer_raw": (CUSTOMER_RAW, True),
    "account_raw": (ACCOUNT_RAW, False),
    "transaction_raw": (TRANSACTION_RAW, False),
}


def ingest_bronze(spark: SparkSession, landing: dict[str, str], bronze_root: str,
                  max_files_per_trigger: int | None = None) -> BronzeLayer:
    """One scheduled bronze run over the three landing folders.

    ``landing`` maps table name to its landing folder; tables and their stream
    checkpoints live under ``bronze_root`` (a shared filesystem path).  Files
    loaded by an earlier run are skipped.  Lines with too few or too many fields or an
    unclosed quote are kept apart from the tables, in ``quarantine``.
    """
    out, held = {}, []
    for name, (schema, lineage) in BRONZE_TABLES.items():
        path = f"{bronze_root.rstrip('/')}/{name}"
        out[name] = load_incremental(
            spark, landing[name], schema, path,
            f"{bronze_root.rstrip('/')}/_checkpoints/{name}", lineage=lineage,
            max_files_per_trigger=max_files_per_trigger, quarantine=True)
        held.append(quarantined(spark, path).select(F.lit(name.removesuffix("_raw")).alias("TableName"), "RawFile", "RawLine"))
    return BronzeLayer(out["customer_raw"], out["account_raw"], out["transaction_raw"], reduce(DataFrame.unionByName, held))
