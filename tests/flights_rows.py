"""Raw flight rows drawn from the contract's own value sets; each test overrides what it is about."""

from __future__ import annotations

import random
from datetime import date, datetime

from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from snapstrata.contracts.flights import AIRLINES, CABINS, CITIES, DAY_PARTS, FARE_COLUMNS

# ---- fixed values: the columns of the raw table, the file's and the lineage ----
LINEAGE = (
    ("_source_file", StringType()),
    ("_ingested_at", TimestampType()),
    ("_batch_id", StringType()),
    ("_file_hash", StringType()),
    ("as_of_date", DateType()),
)
# ---- end of fixed values ----
RAW_SCHEMA = StructType(
    [StructField("_source_row" if n == "index" else n, t) for n, t in FARE_COLUMNS]
    + [StructField(n, t) for n, t in LINEAGE]
)


def clean_row(seed: int = 0) -> dict:
    """A row that breaks no rule; with one stop, so that its duration is free."""
    rng = random.Random(seed)
    origin, target = rng.sample(CITIES, 2)
    return {
        "_source_row": seed + 1,
        "airline": rng.choice(AIRLINES),
        "flight": f"{rng.choice('QWXZ')}{rng.choice('QWXZ')}-{rng.randint(100, 999)}",
        "source_city": origin,
        "destination_city": target,
        "departure_time": rng.choice(DAY_PARTS),
        "arrival_time": rng.choice(DAY_PARTS),
        "stops": "one",
        "class": rng.choice(CABINS),
        "duration": rng.randint(4, 40) / 4,
        "days_left": rng.randint(1, 300),
        "price": rng.randint(1000, 90_000),
        "_source_file": "fares.csv",
        "_ingested_at": datetime(2025, 3, 1, 9),
        "_batch_id": "batch",
        "_file_hash": "hash",
        "as_of_date": date(2025, 3, 1),
    }


def raw(spark, *overrides: dict):
    rows = [{**clean_row(), **o} for o in overrides or ({},)]
    return spark.createDataFrame([tuple(r[f.name] for f in RAW_SCHEMA) for r in rows], RAW_SCHEMA)
