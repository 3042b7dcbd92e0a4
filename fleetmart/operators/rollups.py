"""Payments rolled up to rentals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.expressions import money
from ..session import cut_lineage

METHOD_LIMIT = 50  # width of the payment_method column
SEPARATOR = ", "
# A list of distinct methods grows by at least one character and the separator with each further method, so only the
# first ones in order can reach into the column.
METHODS_NEEDED = METHOD_LIMIT // (1 + len(SEPARATOR)) + 2
#: Rentals are counted in so many groups; one of a group of at most GROUP_PAYMENTS has few payments.
GROUPS = 1 << 16
GROUP_PAYMENTS = 100_000


def rental_totals(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Rentals with the total of their payments, 0 if there are none."""
    paid = payments.groupBy("transaction_id").agg(F.sum("amount").alias("total_cost"))
    return rentals.join(paid, "transaction_id", "left").select(
        "transaction_id", "customer_id", "vehicle_id", "employee_id", "rental_start_date", "rental_end_date",
        money(F.coalesce("total_cost", F.lit(0))).alias("total_cost"),
    )


def method_lists(payments: DataFrame) -> DataFrame:
    """Per rental the ordered list of distinct methods, cut to the column width.

    The rank limit is applied before the shuffle by rental as well, and only methods that can show are collected.
    """
    distinct = payments.filter(F.col("payment_method").isNotNull()).select("transaction_id", "payment_method").distinct()
    first = F.row_number().over(Window.partitionBy("transaction_id").orderBy("payment_method"))
    shown = distinct.withColumn("_rank", first).filter(F.col("_rank") <= METHODS_NEEDED)
    listed = F.array_join(F.array_sort(F.collect_list("payment_method")), SEPARATOR)
    return shown.groupBy("transaction_id").agg(F.left(listed, F.lit(METHOD_LIMIT)).alias("payment_method"))


def payment_rollup(payments: DataFrame, most: int = GROUP_PAYMENTS) -> DataFrame:
    """Per rental: sum of its payments and the list of its methods.

    Payments move once, as they are, in one pass over their source after the groups are counted. Those of rentals that may have very many (more than
    ``most`` in a group of rentals, and four times what a group has on average) take two ways, each combined on the map side:
    the sums, and the methods under their rank limit.
    """
    group = F.pmod(F.xxhash64("transaction_id"), F.lit(GROUPS))
    sizes = cut_lineage(payments.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n")))
    least = max(most, 4 * (sizes.agg(F.sum("_n")).first()[0] or 0) // GROUPS)
    crowded = sizes.filter(F.col("_n") > least).select("_group")
    if crowded.isEmpty():
        return _rolled_up(payments)
    marked = cut_lineage(payments.withColumn("_group", group))  # read by each of the ways
    calm, many = (marked.join(F.broadcast(crowded), "_group", how).drop("_group") for how in ("left_anti", "left_semi"))
    sums = many.groupBy("transaction_id").agg(money(F.sum("amount")).alias("payment_amount"))
    return _rolled_up(calm).unionByName(sums.join(method_lists(many), "transaction_id", "left"))


def _rolled_up(payments: DataFrame) -> DataFrame:
    """The rollup in one pass, for rentals with few payments. Those without a rental have a sum, but no list."""
    grouped = payments.repartition("transaction_id").groupBy("transaction_id").agg(
        money(F.sum("amount")).alias("payment_amount"), F.collect_set("payment_method").alias("_methods"))
    listed = F.array_join(F.slice(F.array_sort("_methods"), 1, METHODS_NEEDED), SEPARATOR)
    shown = F.when(F.col("transaction_id").isNotNull() & (F.size("_methods") > 0), F.left(listed, F.lit(METHOD_LIMIT)))
    return grouped.select("transaction_id", "payment_amount", shown.alias("payment_method"))
