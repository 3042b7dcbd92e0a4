"""Payment totals kept up to date from changes alone.

The state holds, per rental and payment method, the number of payments and their sum. Both are sums over payments, so a
change is a signed row, states and deltas are added up in any order, and what cancels out is gone. Neither the payments
nor the state of untouched rentals are read to take in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import money
from .lookup import lookup_join
from .rollups import method_lists

STATE = ["transaction_id", "payment_method"]
INSERT, CORRECT, RETRACT = "insert", "correct", "retract"


def signed(changes: DataFrame) -> DataFrame:
    """Payments with a sign: ``old`` and ``new`` (structs with the rental, the amount and the method) of each change. An insert
    has no old, a retraction no new, a correction both; it may move a payment to another rental."""
    rows = F.array(F.struct(F.col("old").alias("p"), F.lit(-1).alias("sign")), F.struct(F.col("new").alias("p"), F.lit(1).alias("sign")))
    return changes.select(F.explode(F.filter(rows, lambda r: r["p"].isNotNull())).alias("r")).select(
        "r.p.transaction_id", "r.p.amount", "r.p.payment_method", "r.sign")


def payment_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What leads from one table of payments to another: kind, old and new per payment id; equal payments are left out."""
    columns = ["transaction_id", "amount", "payment_method"]
    pair = before.select("payment_id", F.struct(*columns).alias("old")).join(
        after.select("payment_id", F.struct(*columns).alias("new")), "payment_id", "full_outer")
    kind = F.when(F.col("old").isNull(), INSERT).when(F.col("new").isNull(), RETRACT).otherwise(CORRECT)
    return pair.filter(~F.col("old").eqNullSafe(F.col("new"))).select("payment_id", kind.alias("kind"), "old", "new")


def delta(rows: DataFrame) -> DataFrame:
    """State of signed payments, in one aggregation that is combined on the map side. All payments of a table with the sign 1
    give the state of the table."""
    summed = rows.groupBy(*STATE).agg(F.sum(F.col("sign").cast("long")).alias("payments"),
                                      F.sum(F.col("amount") * F.col("sign")).alias("amount"))
    return summed.select(*STATE, "payments", money(F.col("amount")).alias("amount")).filter("payments <> 0 OR amount <> 0")


def merged(*states: DataFrame) -> DataFrame:
    """States and deltas as one state. Rows that cancel out are left out; a negative number of payments means that something
    was taken back that the state never held (see ``unfounded``)."""
    every = states[0].select(*STATE, "payments", "amount")
    for state in states[1:]:
        every = every.unionByName(state.select(*STATE, "payments", "amount"))
    return every.groupBy(*STATE).agg(F.sum("payments").alias("payments"), money(F.sum("amount")).alias("amount")).filter(
        "payments <> 0 OR amount <> 0")


def unfounded(state: DataFrame) -> DataFrame:
    """Rows of a state that can't come from payments: fewer than none, or an amount of none."""
    return state.filter("payments < 0 OR payments = 0 AND amount <> 0")


def maintained_totals(rentals: DataFrame, state: DataFrame) -> DataFrame:
    """Rentals with the total of their payments, 0 if there are none, and the ordered list of their methods, from a state."""
    held = state.filter("payments > 0")
    sums = held.groupBy("transaction_id").agg(money(F.sum("amount")).alias("total_cost"))
    rows = lookup_join(rentals.select("transaction_id"), sums, ["transaction_id"])
    return rows.join(method_lists(held), "transaction_id", "left").select(
        "transaction_id", money(F.coalesce("total_cost", F.lit(0))).alias("total_cost"), "payment_method")
