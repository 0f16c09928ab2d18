"""Extensions: variants of the themes that their documents describe, and a history theme; one row a key that has rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebody.functions.expr import coalesce0, count_if, ratio, true_int
from orebody.operators.themes import CURR, PREV


def acceleration(short: str, long: str, short_days: int = 30, long_days: int = 60):
    """A / (B - A), scaled to equal spans."""
    return ratio(coalesce0(F.col(short)), coalesce0(F.col(long)) - coalesce0(F.col(short))) * (long_days / short_days - 1)


def velocity(prev: DataFrame, bureau: DataFrame | None = None) -> DataFrame:
    """90-day counts, the least gap, bursts of at most three days; fresh and active credits elsewhere."""
    days = prev.groupBy(CURR, "DAYS_DECISION").agg(F.count("*").alias("__n"))  # equal days first: gaps between them are 0
    d, n = F.col("DAYS_DECISION"), F.col("__n")
    step = F.abs(d - F.lag(d).over(Window.partitionBy(CURR).orderBy(d)))
    least = F.min(F.when(d.isNotNull(), F.when(n > 1, F.lit(0)).otherwise(F.col("__gap"))))
    out = days.withColumn("__gap", step).groupBy(CURR).agg(
        F.sum(F.when(d >= -90, n).otherwise(0)).alias("velocity_prev_count_90d"),
        least.alias("velocity_prev_decision_gap_min"),
        true_int(least <= 3).alias("velocity_prev_burst_flag"),
    )
    if bureau is not None:
        aggs = [count_if(F.col("DAYS_CREDIT") >= -7).alias("velocity_bureau_recent_credit_count_7d")]
        if "CREDIT_ACTIVE" in bureau.columns:
            aggs.append(count_if(F.col("CREDIT_ACTIVE") == "Active").alias("velocity_bureau_active_count"))
        out = out.join(bureau.groupBy(CURR).agg(*aggs), CURR, "full")
    return out


def consistency(prev: DataFrame) -> DataFrame:
    """Deviation of credit less asked amount (of samples), number of statuses, and the span of stated years of work."""
    aggs = [F.stddev_samp(F.col("AMT_CREDIT") - F.col("AMT_APPLICATION")).alias("consistency_prev_credit_gap_std")]
    if "NAME_CONTRACT_STATUS" in prev.columns:
        aggs.append(F.count_distinct("NAME_CONTRACT_STATUS").alias("consistency_prev_status_types"))
    if "DAYS_EMPLOYED" in prev.columns:
        years = F.abs(F.col("DAYS_EMPLOYED")) / 365.0
        aggs.append((F.max(years) - F.min(years)).alias("consistency_employed_years_change"))
    return prev.groupBy(CURR).agg(*aggs)


def cashout(prev: DataFrame, card: DataFrame | None = None, instalments: DataFrame | None = None) -> DataFrame:
    """Largest cash share and number of cash drawings, use of the limit; mean gap of first payments, late amounts, spread of gaps.

    Rows are summed by contract first, so that the join to the owners carries one row a contract.
    """
    owners, out = prev.select(PREV, CURR).dropDuplicates(), None
    if card is not None:
        atm, total = F.col("AMT_DRAWINGS_ATM_CURRENT"), F.col("AMT_DRAWINGS_CURRENT")
        aggs = [F.max(atm / (F.abs(total) + 1)).alias("m"), count_if(atm > 0).alias("c")]
        last = [F.max("m").alias("cashout_atm_ratio_max"), F.sum("c").alias("cashout_atm_count")]
        if {"AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"} <= set(card.columns):
            use = ratio(F.col("AMT_BALANCE"), F.col("AMT_CREDIT_LIMIT_ACTUAL"))
            aggs += [F.max(use).alias("u"), F.sum(use).alias("us"), F.count(use).alias("un")]
            last += [F.max("u").alias("cashout_credit_utilization_max"), ratio(F.sum("us"), F.sum("un")).alias("cashout_credit_utilization_mean")]
        out = card.groupBy(PREV).agg(*aggs).join(owners, PREV).groupBy(CURR).agg(*last)
    if instalments is not None:
        gap = (F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")).cast("double")
        first = F.when(F.col("NUM_INSTALMENT_NUMBER") == 1, gap)
        aggs = [F.sum(first).alias("f"), F.count(first).alias("fn"), F.sum(gap).alias("s"), F.sum(gap * gap).alias("s2"), F.count(gap).alias("n")]
        n = F.sum("n").cast("double")
        spread = F.when(n > 1, F.sqrt(F.greatest((F.sum("s2") - F.sum("s") * F.sum("s") / n) / (n - 1), F.lit(0.0))))
        last = [ratio(F.sum("f"), F.sum("fn")).alias("cashout_first_payment_gap_mean"), spread.alias("cashout_payment_gap_std")]
        if "AMT_INSTALMENT" in instalments.columns:
            due = F.col("AMT_INSTALMENT")
            aggs += [F.sum(F.when(gap > 0, due).otherwise(F.when(due.isNotNull(), 0.0))).alias("l"), F.sum(due).alias("d")]
            last.append(ratio(F.sum("l"), F.sum("d")).alias("cashout_installments_late_amount_ratio"))
        paid = instalments.groupBy(PREV).agg(*aggs).join(owners, PREV).groupBy(CURR).agg(*last)
        out = paid if out is None else out.join(paid, CURR, "full")
    return out if out is not None else owners.select(CURR).distinct()


def history(prev: DataFrame) -> DataFrame:
    """How many contracts a key has had, of which refused, and how long ago the first and the last were decided."""
    refused = F.col("NAME_CONTRACT_STATUS") == "Refused" if "NAME_CONTRACT_STATUS" in prev.columns else F.lit(False)
    return prev.groupBy(CURR).agg(
        F.count("*").alias("history_prev_count"),
        ratio(count_if(refused), F.count("*")).alias("history_prev_refused_ratio"),
        F.max(-F.col("DAYS_DECISION")).alias("history_first_decision_days"),
        F.min(-F.col("DAYS_DECISION")).alias("history_last_decision_days"),
    )
