"""Inputs of the query catalogue, derived from the driver's tables.

The reference's own inputs (flight delays, loans, usage records) are not
shipped, so each is re-expressed as a view over a given table.  Every view
is a row-wise projection, so it grows with its table and costs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.temporal import COMPACT_FORMAT
from kiln.sources.literal import synthetic_usage

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Airport codes used as flight endpoints, in this order.
AIRPORTS = ("SEA", "SFO", "JFK", "DEN", "ORD", "LAX", "ATL")
# Origin airport of each event type.
ORIGIN_BY_EVENT = (
    ("click", "SEA"),
    ("error", "SFO"),
    ("purchase", "JFK"),
    ("signup", "DEN"),
    ("view", "ORD"),
)
DISTANCE_PER_USER = 10

# Loans view over customer.
LOAN_NULL_PAID_EVERY = 97
FUNDED_PER_NATION = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _origin(event_type):
    expr = None
    for ev, code in ORIGIN_BY_EVENT:
        expr = F.when(event_type == ev, code) if expr is None else expr.when(event_type == ev, code)
    return expr


def flights(events: DataFrame) -> DataFrame:
    """Flight-delay rows from events.

    ``date`` is ``MMddHHmm`` text of ``ts``, ``delay`` the whole part of
    ``value``, ``distance`` ten times ``user_id``, ``origin`` a fixed airport
    per event type and ``destination`` the airport at ``user_id mod 7``.
    """
    airports = F.array(*[F.lit(a) for a in AIRPORTS])
    dest_idx = (F.pmod(F.col("user_id"), F.lit(len(AIRPORTS))) + F.lit(1)).cast("int")
    return events.select(
        F.date_format("ts", COMPACT_FORMAT).alias("date"),
        F.floor("value").try_cast("int").alias("delay"),
        (F.col("user_id") * F.lit(DISTANCE_PER_USER)).alias("distance"),
        _origin(F.col("event_type")).alias("origin"),
        F.element_at(airports, dest_idx).alias("destination"),
    )


def loans(customer: DataFrame) -> DataFrame:
    """Loan rows from customers; every 97th paid amount is NULL."""
    return customer.select(
        F.col("c_custkey").alias("loan_id"),
        (F.col("c_nationkey") * F.lit(FUNDED_PER_NATION)).cast("int").alias("funded_amnt"),
        F.when(F.col("c_custkey") % LOAN_NULL_PAID_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal"))
        .alias("paid_amnt"),
        F.col("c_mktsegment").alias("addr_state"),
    )


def usage(customer: DataFrame, seed: int = 42) -> DataFrame:
    """Usage records, one per customer key (see ``synthetic_usage``)."""
    return synthetic_usage(customer.select("c_custkey"), "c_custkey", seed=seed)
