"""Enrichment, star schema, feature and risk queries over the silver frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import gold, risk, scoring
from ledgerline.operators.enrich import enrich
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.plans.rows import silver_frame
from ledgerline.schemas import AUTH_LOGS, SYSTEM_LOGS, TRANSACTIONS

TX, AUTH, SYS = (sql.silver(s) for s in (TRANSACTIONS, AUTH_LOGS, SYSTEM_LOGS))
DATE_KEY = "CAST(year(dt) * 10000 + month(dt) * 100 + day(dt) AS INTEGER)"


@query(
    "enrich_customer",
    f"SELECT event_id, user_id, CAST(dt AS VARCHAR) AS dt, c_mktsegment, n_name FROM ({AUTH}) "
    "LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def enrich_customer(spark, sf_dir):
    customers = fixtures.table(spark, sf_dir, "customer")
    nations = fixtures.table(spark, sf_dir, "nation")
    master = enrich(customers, nations, [("c_nationkey", "n_nationkey")], ["n_name"])
    events = silver_frame(spark, sf_dir, AUTH_LOGS).select("event_id", "user_id", "dt")
    return enrich(events, master, [("user_id", "c_custkey")], ["c_mktsegment", "n_name"])


@query(
    "gold_fact_transactions",
    f"SELECT transaction_id, {DATE_KEY} AS date_key, customer_id, merchant, amount, is_fraud FROM ({TX})",
)
def gold_fact_transactions(spark, sf_dir):
    return gold.fact_transactions(silver_frame(spark, sf_dir, TRANSACTIONS))


@query(
    "gold_dim_date",
    f"SELECT DISTINCT {DATE_KEY} AS date_key, CAST(dt AS VARCHAR) AS dt, CAST(year(dt) AS INTEGER) AS year, "
    "CAST(quarter(dt) AS INTEGER) AS quarter, CAST(month(dt) AS INTEGER) AS month, CAST(day(dt) AS INTEGER) AS day, "
    "CAST(isodow(dt) - 1 AS INTEGER) AS weekday, CASE WHEN isodow(dt) >= 6 THEN 1 ELSE 0 END AS is_weekend "
    f"FROM ({TX}) WHERE dt IS NOT NULL",
)
def gold_dim_date(spark, sf_dir):
    return gold.dim_date(silver_frame(spark, sf_dir, TRANSACTIONS))


def _dimension_sql(column):
    return (
        f"SELECT {column}, CAST(min(dt) AS VARCHAR) AS first_dt, CAST(max(dt) AS VARCHAR) AS last_dt, count(*) AS n "
        f"FROM ({TX}) GROUP BY {column}"
    )


@query("gold_dim_merchant", _dimension_sql("merchant"))
def gold_dim_merchant(spark, sf_dir):
    return gold.dim_merchant(silver_frame(spark, sf_dir, TRANSACTIONS))


@query("gold_dim_customer", _dimension_sql("customer_id"))
def gold_dim_customer(spark, sf_dir):
    return gold.dim_customer(silver_frame(spark, sf_dir, TRANSACTIONS))


@query(
    "features_customer_daily",
    f"SELECT customer_id, CAST(dt AS VARCHAR) AS dt, count(*) AS n, {sql.MONEY} AS total, max(amount) AS largest, "
    f"CAST(sum(is_fraud) AS BIGINT) AS frauds FROM ({TX}) GROUP BY customer_id, dt",
)
def features_customer_daily(spark, sf_dir):
    return gold.customer_daily(silver_frame(spark, sf_dir, TRANSACTIONS))


_LOGIN = "action = 'login'"


@query(
    "features_rolling_24h",
    f"WITH a AS (SELECT *, epoch_us(\"timestamp\") // 1000000 AS sec FROM ({AUTH})) "
    "SELECT event_id, user_id, \"timestamp\", "
    f"CAST(coalesce(sum(CASE WHEN {_LOGIN} THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS logins_24h, "
    f"CAST(coalesce(sum(CASE WHEN {_LOGIN} AND is_success = 0 THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS failures_24h "
    "FROM a WHERE \"timestamp\" IS NOT NULL "
    "WINDOW w AS (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING) "
    "UNION ALL SELECT event_id, user_id, \"timestamp\", 0, 0 FROM a WHERE \"timestamp\" IS NULL",
)
def features_rolling_24h(spark, sf_dir):
    history = risk.login_history(silver_frame(spark, sf_dir, AUTH_LOGS))
    return history.select("event_id", "user_id", "timestamp", "logins_24h", "failures_24h")


@query(
    "error_rate_hourly",
    "WITH h AS (SELECT date_trunc('hour', \"timestamp\") AS hour, service, count(*) AS n, "
    f"count(*) FILTER (WHERE log_level = 4) AS errors FROM ({SYS}) WHERE \"timestamp\" IS NOT NULL GROUP BY 1, 2), "
    "r AS (SELECT *, errors * 1000000 // n AS rate_ppm FROM h), "
    "m AS (SELECT *, count(rate_ppm) OVER w AS k, CAST(sum(rate_ppm) OVER w AS BIGINT) AS s, "
    "CAST(sum(rate_ppm * rate_ppm) OVER w AS BIGINT) AS ss FROM r "
    "WINDOW w AS (PARTITION BY service ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)) "
    "SELECT hour, service, n, errors, rate_ppm, CASE WHEN k > 1 AND k * ss - s * s > 0 "
    "THEN CAST(rate_ppm * k - s AS DOUBLE) / sqrt(CAST(k * ss - s * s AS DOUBLE)) END AS z_score FROM m",
)
def error_rate_hourly(spark, sf_dir):
    return risk.error_rate_hourly(silver_frame(spark, sf_dir, SYSTEM_LOGS))


@query(
    "failed_login_burst",
    "SELECT user_id, date_trunc('hour', \"timestamp\") AS hour, count(*) AS failures "
    f"FROM ({sql.silver(AUTH_LOGS)}) WHERE {_LOGIN} AND is_success = 0 AND \"timestamp\" IS NOT NULL "
    "GROUP BY 1, 2 HAVING count(*) >= 2",
)
def failed_login_burst(spark, sf_dir):
    return risk.failed_login_bursts(silver_frame(spark, sf_dir, AUTH_LOGS), at_least=2)


@query(
    "sql_silver_summary",
    "SELECT year(dt)::INTEGER AS year, is_fraud, count(*) AS n, count(DISTINCT customer_id) AS customers, "
    f"{sql.MONEY} AS total FROM ({TX}) GROUP BY 1, 2",
)
def sql_silver_summary(spark, sf_dir):
    """Ad-hoc SQL over silver; the frame is handed over by name for this statement only."""
    return spark.sql(
        """
        SELECT year(dt) AS year, is_fraud, count(*) AS n, count(DISTINCT customer_id) AS customers,
               CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total
        FROM {silver}
        GROUP BY year(dt), is_fraud
        """,
        silver=silver_frame(spark, sf_dir, TRANSACTIONS),
    )


_SCORED = (
    f"SELECT customer_id - CAST(date_diff('day', DATE '1995-01-01', dt) AS INTEGER) AS score, is_fraud FROM ({TX})"
)


@query(
    "auc_exact",
    f"WITH g AS (SELECT score, count(*) FILTER (WHERE is_fraud = 1) AS p, count(*) FILTER (WHERE is_fraud <> 1) AS n "
    f"FROM ({_SCORED}) GROUP BY score), "
    "c AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b "
    "FROM g), s AS (SELECT CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, "
    "CAST(sum(p * (2 * b + n)) AS DOUBLE) AS wins FROM c) "
    "SELECT positives, negatives, "
    "wins / (2.0::DOUBLE * CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE)) AS auc FROM s",
)
def auc_exact(spark, sf_dir):
    """ROC-AUC of a fixed linear score."""
    scored = silver_frame(spark, sf_dir, TRANSACTIONS).select(
        (F.col("customer_id") - F.datediff("dt", F.lit("1995-01-01").cast("date"))).alias("score"), "is_fraud"
    )
    return scoring.exact_auc(scored, "score", "is_fraud")
