"""The driver's tables in the roles of the feature-mining schema, as DataFrames and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.operators import themes
from orebody.sources.io import clean

#: Days count back from these dates, just after the last order and event.
ASOF_ORDERS, ASOF_EVENTS = "2001-08-02", "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    days = lambda c, asof: F.datediff(F.col(c).cast("date"), F.lit(asof).cast("date"))
    customer, orders, lineitem, events = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem", "events"))
    k = F.col("c_custkey")
    asked = lineitem.groupBy(F.col("l_orderkey").alias("SK_ID_PREV")).agg(F.round(F.sum("l_extendedprice"), 2).alias("AMT_APPLICATION"))
    return {
        "application": customer.select(
            k.alias("SK_ID_CURR"),
            (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
            (-(k * 13 % 6000)).alias("DAYS_EMPLOYED"),
            (-(k * 37 % 20000)).alias("DAYS_BIRTH"),
            (k % 2).alias("FLAG_MOBIL"),
            (k % 3 % 2).alias("FLAG_EMP_PHONE"),
            (k % 5 % 2).alias("FLAG_WORK_PHONE"),
            F.col("c_mktsegment").alias("segment"),
        ),
        "previous_application": orders.select(
            F.col("o_orderkey").alias("SK_ID_PREV"),
            F.col("o_custkey").alias("SK_ID_CURR"),
            F.col("o_totalprice").alias("AMT_CREDIT"),
            F.col("o_orderstatus").alias("NAME_CONTRACT_STATUS"),
            days("o_orderdate", ASOF_ORDERS).alias("DAYS_DECISION"),
        ).join(asked, "SK_ID_PREV", "left"),
        "bureau": events.select(F.col("user_id").alias("SK_ID_CURR"), days("ts", ASOF_EVENTS).alias("DAYS_CREDIT")),
        "credit_card_balance": lineitem.select(
            F.col("l_orderkey").alias("SK_ID_PREV"), (F.col("l_tax") * F.col("l_extendedprice")).alias("AMT_DRAWINGS_ATM_CURRENT"), F.col("l_extendedprice").alias("AMT_DRAWINGS_CURRENT")
        ),
        "installments_payments": lineitem.select(
            F.col("l_orderkey").alias("SK_ID_PREV"),
            F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
            days("l_shipdate", ASOF_ORDERS).alias("DAYS_INSTALMENT"),
            (days("l_shipdate", ASOF_ORDERS) + F.col("l_quantity").cast("int") - 20).alias("DAYS_ENTRY_PAYMENT"),
        ),
    }


FRAMES_SQL = f"""
application AS (SELECT c_custkey AS "SK_ID_CURR", (c_acctbal < 0)::INT AS "TARGET", -(c_custkey * 13 % 6000) AS "DAYS_EMPLOYED", -(c_custkey * 37 % 20000) AS "DAYS_BIRTH",
  c_custkey % 2 AS "FLAG_MOBIL", c_custkey % 3 % 2 AS "FLAG_EMP_PHONE", c_custkey % 5 % 2 AS "FLAG_WORK_PHONE", c_mktsegment AS segment FROM customer),
asked AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS "AMT_APPLICATION" FROM lineitem GROUP BY 1),
previous_application AS (SELECT o_orderkey AS "SK_ID_PREV", o_custkey AS "SK_ID_CURR", o_totalprice AS "AMT_CREDIT", o_orderstatus AS "NAME_CONTRACT_STATUS",
  date_diff('day', DATE '{ASOF_ORDERS}', o_orderdate::DATE) AS "DAYS_DECISION", "AMT_APPLICATION" FROM orders LEFT JOIN asked ON l_orderkey = o_orderkey),
bureau AS (SELECT user_id AS "SK_ID_CURR", date_diff('day', DATE '{ASOF_EVENTS}', ts::DATE) AS "DAYS_CREDIT" FROM events),
card_rows AS (SELECT l_orderkey AS "SK_ID_PREV", l_tax * l_extendedprice AS atm, l_extendedprice AS total FROM lineitem),
inst AS (SELECT l_orderkey AS "SK_ID_PREV", l_linenumber AS num, l_quantity::INT - 20 AS late FROM lineitem),
owner AS (SELECT DISTINCT "SK_ID_PREV", "SK_ID_CURR" FROM previous_application),
velocity_prev AS (SELECT "SK_ID_CURR", count(*) FILTER ("DAYS_DECISION" >= -7) AS velocity_prev_count_7d, count(*) FILTER ("DAYS_DECISION" >= -30) AS velocity_prev_count_30d
  FROM previous_application GROUP BY 1),
gaps AS (SELECT "SK_ID_CURR", abs("DAYS_DECISION" - lag("DAYS_DECISION") OVER (PARTITION BY "SK_ID_CURR" ORDER BY "DAYS_DECISION")) AS gap FROM previous_application),
velocity_gap AS (SELECT "SK_ID_CURR", CASE WHEN count(gap) >= 2 THEN stddev_pop(gap) END AS velocity_prev_decision_gap_std FROM gaps GROUP BY 1),
velocity_bureau AS (SELECT "SK_ID_CURR", count(*) FILTER ("DAYS_CREDIT" >= -30) AS velocity_bureau_recent_credit_count_30d FROM bureau GROUP BY 1),
consistency_prev AS (SELECT "SK_ID_CURR", avg(abs("AMT_CREDIT" - "AMT_APPLICATION") / (abs("AMT_APPLICATION") + 1)) AS consistency_prev_credit_gap_ratio_mean,
  count(DISTINCT "NAME_CONTRACT_STATUS")::DOUBLE / nullif(count("AMT_APPLICATION"), 0) AS consistency_prev_status_change_rate FROM previous_application GROUP BY 1),
cash AS (SELECT "SK_ID_CURR", avg(atm / (abs(total) + 1)) AS cashout_atm_ratio_mean FROM card_rows JOIN owner USING ("SK_ID_PREV") GROUP BY 1),
late AS (SELECT "SK_ID_CURR", max(late) FILTER (num = 1) AS cashout_first_payment_delinquency_days_max, avg((late > 0)::INT) AS cashout_installments_late_ratio,
  count(*) FILTER (num = 1) AS firsts FROM inst JOIN owner USING ("SK_ID_PREV") GROUP BY 1)"""

ORDER_FEATURES = """orders_by AS (SELECT o_custkey AS "SK_ID_CURR", count(*) AS order_count, round(sum(o_totalprice), 2) AS order_total, round(avg(o_totalprice), 4) AS order_mean,
  max(date_diff('day', DATE '2001-08-02', o_orderdate::DATE)) AS last_day FROM orders GROUP BY 1)"""

MATRIX_SQL = f"""{FRAMES_SQL}, {ORDER_FEATURES},
matrix AS (SELECT a."SK_ID_CURR", a."TARGET", a."FLAG_MOBIL", a.segment, velocity_prev_count_30d, round(velocity_prev_decision_gap_std, 6) AS velocity_prev_decision_gap_std,
  velocity_bureau_recent_credit_count_30d, round(cashout_installments_late_ratio, 6) AS cashout_installments_late_ratio, order_count, order_total, order_mean, last_day,
  order_total * 2 AS order_total_twice, 1 AS constant, CASE WHEN a."SK_ID_CURR" % 50 = 0 THEN a."SK_ID_CURR" END AS mostly_null
  FROM application a LEFT JOIN velocity_prev USING ("SK_ID_CURR") LEFT JOIN velocity_gap USING ("SK_ID_CURR") LEFT JOIN velocity_bureau USING ("SK_ID_CURR")
  LEFT JOIN late USING ("SK_ID_CURR") LEFT JOIN orders_by USING ("SK_ID_CURR"))"""


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a customer: key, TARGET, features of all kinds, and ones that filters should drop."""
    f = frames(spark, sf_dir)
    app = f["application"].select("SK_ID_CURR", "TARGET", "FLAG_MOBIL", "segment")
    velocity = themes.get_theme("velocity").build(f, app).select(
        "SK_ID_CURR", "velocity_prev_count_30d", F.round("velocity_prev_decision_gap_std", 6).alias("velocity_prev_decision_gap_std"), "velocity_bureau_recent_credit_count_30d"
    )
    cash = themes.get_theme("cashout").build(f, app).select("SK_ID_CURR", F.round("cashout_installments_late_ratio", 6).alias("cashout_installments_late_ratio"))
    orders = f["previous_application"].groupBy("SK_ID_CURR").agg(
        F.count("*").alias("order_count"), F.round(F.sum("AMT_CREDIT"), 2).alias("order_total"), F.round(F.avg("AMT_CREDIT"), 4).alias("order_mean"), F.max("DAYS_DECISION").alias("last_day")
    )
    out = app.join(velocity, "SK_ID_CURR", "left").join(cash, "SK_ID_CURR", "left").join(orders, "SK_ID_CURR", "left")
    return out.withColumns(
        {
            "order_total_twice": F.col("order_total") * 2,
            "constant": F.lit(1),
            "mostly_null": F.when(F.col("SK_ID_CURR") % 50 == 0, F.col("SK_ID_CURR")),
        }
    )


NUMERIC = ["FLAG_MOBIL", "velocity_prev_count_30d", "velocity_prev_decision_gap_std", "velocity_bureau_recent_credit_count_30d", "cashout_installments_late_ratio", "order_count", "order_total", "order_mean", "last_day"]

#: A target that two of the features explain, for queries whose result would else be empty.
SIGNAL = "(coalesce(order_mean, 0) > 190000 OR coalesce(order_count, 0) > 14)::INT"


def with_signal(df: DataFrame) -> DataFrame:
    """The matrix with that target."""
    strong = (F.coalesce("order_mean", F.lit(0)) > 190000) | (F.coalesce("order_count", F.lit(0)) > 14)
    return df.withColumn("TARGET", strong.cast("int"))
