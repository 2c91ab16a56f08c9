"""Profiles over time, drift, and change feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import changefeed, profile, tables
from ledgerline.operators.clean import clean
from ledgerline.operators.dedup import one_per_key
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.plans.rows import silver_frame
from ledgerline.schemas import AUTH_LOGS
from ledgerline.session import fresh_dir

AUTH = sql.silver(AUTH_LOGS)
PROFILED = ("user_id", "action", "ip_address", "geo_lat", "is_success")
NUMBERS = {"user_id", "geo_lat", "is_success"}
# What the estimates are held to: three standard deviations of the distinct count, and a rank's error.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.025


def _profiles(spark, sf_dir):
    """A table filled in two steps, and its profiles, brought up to date after each; no day is read twice."""
    path, profiles = fresh_dir(spark, "silver"), fresh_dir(spark, "profiles")
    rows = silver_frame(spark, sf_dir, AUTH_LOGS).filter(F.col("dt").isNotNull())
    read = []
    for part in ("dt < '2024-01-16'", "dt >= '2024-01-16'"):
        tables.append(rows.filter(part), path)
        read += profile.profile_new_days(spark, path, profiles, PROFILED)
    if len(read) != len(set(read)):
        raise AssertionError("a day was read twice")
    return spark.read.parquet(profiles)


def _exact_sql(by: str) -> str:
    def one(c):
        low = f"CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE)" if c in NUMBERS else "NULL::DOUBLE, NULL::DOUBLE"
        return f"SELECT {by} '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS nulls, {low} FROM s GROUP BY ALL"

    head = f"{'dt, ' if by else ''}column_name, n, nulls, low, high"
    return f"WITH s AS (SELECT * FROM ({AUTH}) WHERE dt IS NOT NULL), p({head}) AS ({' UNION ALL '.join(map(one, PROFILED))}) "


@query("profile_daily", _exact_sql("CAST(dt AS VARCHAR) AS dt,") + "SELECT * FROM p")
def profile_daily(spark, sf_dir):
    """What is exact in the kept profiles, by day."""
    return _profiles(spark, sf_dir).select(F.col("dt").cast("string").alias("dt"), "column_name", "n", "nulls", "low", "high")


@query("profile_range", _exact_sql("") + "SELECT *, true AS distinct_close, true AS quantiles_close FROM p")
def profile_range(spark, sf_dir):
    """All days merged from their profiles, and whether the estimates lie within the stated errors of one exact pass."""
    merged = profile.merged_profile(_profiles(spark, sf_dir))
    rows = silver_frame(spark, sf_dir, AUTH_LOGS).filter(F.col("dt").isNotNull())
    kinds = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"), (F.col(c).cast("double") if c in NUMBERS else F.lit(None).cast("double")).alias("x")) for c in PROFILED]
    long = rows.select(F.explode(F.array(*kinds)).alias("c")).select("c.*")
    told = long.join(merged.select("column_name", "quantiles"), "column_name")
    ranks = [
        F.struct(
            F.count_if(F.col("x") < F.element_at("quantiles", i + 1)).alias("below"),
            F.count_if(F.col("x") <= F.element_at("quantiles", i + 1)).alias("upto"),
            F.lit(q).alias("q"),
        )
        for i, q in enumerate(profile.QUANTILES)
    ]
    exact = told.groupBy("column_name").agg(F.count_distinct("v").alias("exact"), F.count("x").alias("some"), F.array(*ranks).alias("ranks"))

    def close(r):
        return (r["below"] <= (r["q"] + RANK_ERROR) * F.col("some")) & (r["upto"] >= (r["q"] - RANK_ERROR) * F.col("some"))

    return merged.join(exact, "column_name").select(
        "column_name", "n", "nulls", "low", "high",
        (F.abs(F.col("distinct") - F.col("exact")) <= DISTINCT_ERROR * F.col("exact") + 0.5).alias("distinct_close"),
        F.forall("ranks", close).alias("quantiles_close"),
    )


_LAST = "2024-01-24"


@query(
    "profile_drift",
    f"WITH s AS (SELECT * FROM ({AUTH}) WHERE dt IS NOT NULL), "
    + "o AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (count(*) - count({c})) / count(*) AS was FROM s WHERE dt < '{_LAST}'" for c in PROFILED
    )
    + "), c AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (count(*) - count({v})) / count(*) AS now FROM s WHERE dt >= '{_LAST}'"
        for c, v in ((c, {"action": "CASE WHEN user_id % 3 > 0 THEN action END", "geo_lat": "NULL"}.get(c, c)) for c in PROFILED)
    )
    + "), m AS (SELECT count(geo_lat) AS old FROM s WHERE dt < '" + _LAST + "') "
    "SELECT column_name, 'nulls' AS reason, was, now FROM o JOIN c USING (column_name) WHERE abs(now - was) > 0.02 "
    "UNION ALL SELECT 'geo_lat', 'missing', CAST(old AS DOUBLE), 0.0::DOUBLE FROM m WHERE old > 0",
)
def profile_drift(spark, sf_dir):
    """Late days with a column lost and another one thinned out, against the profiles of the days before."""
    baseline = profile.merged_profile(_profiles(spark, sf_dir).filter(f"dt < '{_LAST}'"))
    rows = silver_frame(spark, sf_dir, AUTH_LOGS).filter(f"dt >= '{_LAST}'")
    rows = rows.withColumn("geo_lat", F.lit(None).cast("double")).withColumn("action", F.when(F.col("user_id") % 3 > 0, F.col("action")))
    now = profile.merged_profile(profile.daily_profiles(rows, PROFILED))
    only_nulls = profile.Limits(distinct_share=1e9, quantile_shift=1e9)
    return profile.drift(now, baseline, only_nulls)


# --- Change feed --------------------------------------------------------------------------------------

_STATE = f"SELECT * EXCLUDE (b), b AS batch FROM ({sql.upserted(AUTH_LOGS)})"
_FIRST = sql.silver(AUTH_LOGS, fixtures.two_batches_sql(AUTH_LOGS)[0])
_FEED = (
    f"WITH x AS ({_STATE}), a AS (SELECT * FROM ({_FIRST}) WHERE dt IS NOT NULL), "
    "b AS (SELECT * EXCLUDE (batch) FROM x WHERE dt IS NOT NULL AND ip_address IS NOT NULL), "
    "f AS (SELECT 'insert' AS change, b.* FROM b ANTI JOIN a USING (event_id, dt) "
    "UNION ALL SELECT 'delete', a.* FROM a ANTI JOIN b USING (event_id, dt) "
    "UNION ALL SELECT 'update_before', r.* FROM (SELECT * FROM a EXCEPT SELECT * FROM b) r SEMI JOIN b USING (event_id, dt) "
    "UNION ALL SELECT 'update_after', r.* FROM (SELECT * FROM b EXCEPT SELECT * FROM a) r SEMI JOIN a USING (event_id, dt) "
    "UNION ALL SELECT 'insert', * EXCLUDE (batch) FROM x WHERE dt IS NULL AND batch = 2) "
)


def _three_batches(spark, sf_dir):
    """Two batches of logins, and a third that removes the events without an address."""
    stream = AUTH_LOGS
    first, second = (one_per_key(clean(r, stream), stream.keys) for r in fixtures.two_batches(spark, sf_dir, stream))
    path = fresh_dir(spark, "changes")
    gone = first.unionByName(second).filter("ip_address IS NULL AND dt IS NOT NULL")
    for number, rows in ((1, first), (2, second), (3, gone)):
        tables.append_change(rows.withColumn("deleted", F.lit(number == 3)), path, number, "fixture")
    return spark.read.parquet(path).drop("run")


@query("change_feed", _FEED + "SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM f")
def change_feed(spark, sf_dir):
    log = _three_batches(spark, sf_dir)
    return changefeed.change_feed(log, AUTH_LOGS.keys, 1, 3, F.col("deleted")).drop("deleted")


@query(
    "change_feed_applied",
    f"WITH x AS ({_STATE}) SELECT * EXCLUDE (batch) REPLACE (CAST(dt AS VARCHAR) AS dt) FROM x "
    "WHERE dt IS NULL OR ip_address IS NOT NULL",
)
def change_feed_applied(spark, sf_dir):
    """The state after the first batch with the feed applied is the state after the last."""
    log, keys = _three_batches(spark, sf_dir), AUTH_LOGS.keys
    before = tables.as_of(log, keys, 1)
    return changefeed.applied(before, changefeed.change_feed(log, keys, 1, 3, F.col("deleted")), keys).drop("deleted")
