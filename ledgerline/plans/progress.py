"""What a stream wrote, as its listener saw it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators.parse import with_event_date
from ledgerline.operators.tables import append
from ledgerline.plans import fixtures, sql
from ledgerline.plans.registry import query
from ledgerline.schemas import AUTH_LOGS
from ledgerline.session import fresh_dir, streaming_session
from ledgerline.sources.streams import table_appends
from ledgerline.streaming import jobs
from ledgerline.streaming.progress import batches, recording

# Logins arrive in three steps: by time, but those of every third user of the day before a cut come one later.
CUTS = ("2024-01-11", "2024-01-21")
STEP = " + ".join(
    f"CASE WHEN TRY_CAST(\"timestamp\" AS TIMESTAMP) >= CAST('{cut}' AS TIMESTAMP) OR (user_id % 3 = 0 AND "
    f"TRY_CAST(\"timestamp\" AS TIMESTAMP) >= CAST('{cut}' AS TIMESTAMP) - INTERVAL '1' DAY) THEN 0 ELSE 1 END"
    for cut in CUTS
)
_STEPS = f"SELECT *, 2 - ({STEP}) AS step FROM ({sql.silver(AUTH_LOGS)})"


@query(
    "stream_written_rows",
    f"WITH s AS ({_STEPS}), b AS (SELECT step AS batch_id, count(*) AS rows, min(\"timestamp\") AS oldest, "
    'max("timestamp") AS newest FROM s GROUP BY step) '
    "SELECT CAST(2 * batch_id AS BIGINT) AS batch_id, rows, oldest, newest, "
    "CAST(greatest(max(epoch_us(newest)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "- epoch_us(oldest), 0) AS DOUBLE) / 1000000 AS late_by, FALSE AS failed FROM b "
    "UNION ALL SELECT 4, NULL, NULL, NULL, NULL, TRUE",
)
def stream_written_rows(spark, sf_dir):
    """The silver job after each of three steps; before the third one its sink fails once. Between two steps
    lies a batch without rows, in which the watermark moves."""
    bronze, path, checkpoint, record = (fresh_dir(spark, n) for n in ("bronze", "silver", "checkpoint", "record"))
    rows = with_event_date(fixtures.raw(spark, sf_dir, AUTH_LOGS))
    rows = rows.withColumn("_step", 2 - F.expr(STEP.replace('"', "`")))

    def run(target):
        session = streaming_session(spark)
        with recording(session, record):
            source = table_appends(session, AUTH_LOGS.bronze, bronze)
            jobs.drained(jobs.run_silver, source, AUTH_LOGS, target, checkpoint, watermark="60 days", measure=True)

    for number in range(len(CUTS) + 1):
        append(rows.filter(F.col("_step") == number).drop("_step"), bronze)
        if number == len(CUTS):
            try:
                run("nosuchfilesystem://silver")
            except Exception as error:
                if "nosuchfilesystem" not in str(error):
                    raise
        run(path)
    found = batches(spark, record).filter("rows > 0 OR error IS NOT NULL")
    return found.select("batch_id", "rows", "oldest", "newest", "late_by", F.col("error").isNotNull().alias("failed"))
