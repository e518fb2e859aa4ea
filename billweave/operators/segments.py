"""Recency, frequency and monetary segments.

A score depends on a customer's percent rank in the store. It changes at four ranks
only, so it is enough to know, per store and measure, the value standing at each of
those ranks. The values are found from histograms: one row per store and slot, a
running count over the slots, and for amounts one more look into the few slots that
hold a cut. No store is ever sorted in one task, and the ranks are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from billweave.functions.calendar import AsOf, as_of_day
from billweave.functions.predicates import known_store
from billweave.operators.rollups import CUSTOMER_KEY, customer_totals

# Percent ranks up to which a customer scores 5, 4, 3 and 2.
RANK_LIMITS = (0.10, 0.30, 0.60, 0.80)

# Slots per factor of e in 1 + amount, and the slot of NULL, behind all others.
_SLOTS_PER_E = 2048.0
_LAST_SLOT = 1 << 40


def _amount_slot(amount: Column) -> Column:
    """A number that never falls as the amount falls, with a small relative width."""
    size = F.least(F.log1p(F.abs(amount)) * _SLOTS_PER_E, F.lit(1e7))
    signed = F.when(amount < 0, -size).otherwise(size)
    return F.when(amount.isNull(), F.lit(_LAST_SLOT)).otherwise(-F.floor(signed))


def _comparable(amount: Column) -> Column:
    """Amounts with NULL below every other value, as it ranks last."""
    return F.coalesce(amount, F.lit(float("-inf")))


def _last_position(limit: Column, count: Column) -> Column:
    """Largest position p with ``p / (count - 1) <= limit``, as the rank is computed."""
    span = count - 1
    guess = F.floor(limit * span)
    fits = lambda p: p / F.greatest(span, F.lit(1)) <= limit
    return F.when(fits(guess + 1), guess + 1).when(fits(guess), guess).otherwise(guess - 1)


def _positions(histogram: DataFrame, group: list[str], order: Column) -> DataFrame:
    """Rows standing before each histogram row of its group."""
    running = F.sum("rows").over(
        Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return histogram.withColumn("before", running - F.col("rows"))


def _cut_slots(customers: DataFrame) -> DataFrame:
    """Per store, measure and limit: the slot at the limit's position, and the place in it."""
    slots = F.array(
        F.struct(F.lit("r").alias("measure"), F.coalesce("recency_days", F.lit(_LAST_SLOT)).alias("slot")),
        F.struct(F.lit("f").alias("measure"), (-F.col("frequency")).alias("slot")),
        F.struct(F.lit("m").alias("measure"), _amount_slot(F.col("monetary")).alias("slot")),
    )
    histogram = (
        customers.select("storeId", F.inline(slots))
        .groupBy("storeId", "measure", "slot")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    limits = F.array(*[F.struct(F.lit(i).alias("cut"), F.lit(v).alias("limit")) for i, v in enumerate(RANK_LIMITS)])
    return (
        _positions(histogram, ["storeId", "measure"], F.col("slot").asc())
        .withColumn("total", F.sum("rows").over(Window.partitionBy("storeId", "measure")))
        .select("*", F.inline(limits))
        .withColumn("place", _last_position(F.col("limit"), F.col("total")) - F.col("before"))
        .where((F.col("place") >= 0) & (F.col("place") < F.col("rows")))
        .select("storeId", "measure", "cut", "slot", "place")
    )


def _cut_amounts(customers: DataFrame, cut_slots: DataFrame) -> DataFrame:
    """Per store and limit: the amount standing at the limit's position."""
    cuts = cut_slots.where("measure = 'm'").select("storeId", "cut", "slot", "place")
    amounts = (
        customers.select("storeId", "monetary", _amount_slot(F.col("monetary")).alias("slot"))
        .join(cuts.select("storeId", "slot").distinct(), ["storeId", "slot"], "left_semi")
        .groupBy("storeId", "slot", "monetary")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    placed = _positions(amounts, ["storeId", "slot"], F.col("monetary").desc_nulls_last())
    inside = (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("rows"))
    return (
        placed.join(cuts, ["storeId", "slot"])
        .where(inside)
        .select("storeId", "cut", _comparable(F.col("monetary")).alias("amount"))
    )


def _store_cuts(customers: DataFrame) -> DataFrame:
    """One row per store with the cut values of the three measures, best first."""
    cut_slots = _cut_slots(customers)
    counted = cut_slots.where("measure <> 'm'").select("storeId", "measure", "cut", "slot")
    amounts = _cut_amounts(customers, cut_slots).select("storeId", "cut", "amount")
    both = counted.unionByName(amounts.withColumn("measure", F.lit("m")), allowMissingColumns=True)

    def cut(measure: str, index: int, value: str) -> Column:
        wanted = (F.col("measure") == measure) & (F.col("cut") == index)
        return F.max(F.when(wanted, F.col(value)))

    def cuts(measure: str, value: str) -> Column:
        return F.array(*[cut(measure, i, value) for i in range(len(RANK_LIMITS))]).alias(f"{measure}_cuts")

    return both.groupBy("storeId").agg(cuts("r", "slot"), cuts("f", "slot"), cuts("m", "amount"))


def _score(reached) -> Column:
    score = F.lit(1)
    for index in reversed(range(len(RANK_LIMITS))):
        score = F.when(reached(index), F.lit(5 - index)).otherwise(score)
    return score


def _segment() -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    # Segment names and their conditions, the first match counts.
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Star Customers")
        .when((f >= 4) & (r >= 3), "Loyal Customers")
        .when((m >= 4) & (r >= 3), "Big Spenders")
        .when((r == 5) & (f == 1), "New Customers")
        .when((r >= 4) & (f == 2), "Potential Loyalists")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Hibernating")
        .otherwise("Others")
    )


def rfm_segments(bills: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Scores and segment of each customer of a store (store, mobile number and name).

    Nothing runs before the result is asked for. The customers are named three times in the
    plan, and shuffled once; give a rollup of customers made before to scan the bills once.
    """
    customers = customer_totals(bills.where(known_store())).select(
        *CUSTOMER_KEY,
        F.datediff(as_of_day(as_of), F.to_date("last_visit")).cast("bigint").alias("recency_days"),
        F.col("row_count").alias("frequency"),
        F.col("amount_sum").alias("monetary"),
    )
    # One row per store; the planner broadcasts it where its real size allows that.
    cuts = _store_cuts(customers)

    recency = F.coalesce("recency_days", F.lit(_LAST_SLOT))
    scored = (
        customers.join(cuts, "storeId")
        .withColumn("r_score", _score(lambda i: recency <= F.col("r_cuts")[i]))
        .withColumn("f_score", _score(lambda i: -F.col("frequency") <= F.col("f_cuts")[i]))
        .withColumn("m_score", _score(lambda i: _comparable(F.col("monetary")) >= F.col("m_cuts")[i]))
    )
    scores = [F.col(c) for c in ("r_score", "f_score", "m_score")]
    return scored.select(
        "storeId",
        "mobileNumber",
        "name",
        "recency_days",
        "frequency",
        "monetary",
        *scores,
        F.concat(*[s.cast("string") for s in scores]).alias("rfm_segment"),
        (scores[0] + scores[1] + scores[2]).alias("rfm_score"),
        _segment().alias("customer_segment"),
    )


def cust_segment_count(segments: DataFrame) -> DataFrame:
    """Distinct mobile numbers by store and segment, from ``rfm_segments``."""
    return segments.groupBy("storeId", "customer_segment").agg(
        F.count_distinct("mobileNumber").alias("count_of_customers")
    )


def cust_segment_spend(segments: DataFrame) -> DataFrame:
    """Money spent by store and segment, from ``rfm_segments``."""
    return segments.groupBy("storeId", "customer_segment").agg(F.sum("monetary").alias("total_amount_spent"))
