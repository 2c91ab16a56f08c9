"""What must not grow with the tables: micro-batches of a log, rows of a training task, passes over the payments."""

from pyspark.sql import functions as F

from ledgerline.operators import scoring
from ledgerline.plans import QUERIES, streams
from ledgerline.schemas import TRANSACTIONS

SF_DIR = "/root/testdata/sf0.001"


def test_a_longer_log_takes_no_more_micro_batches(spark, folder):
    for files, bound in ((2, "1"), (9, "3")):
        log = folder(f"log{files}")
        spark.range(90).repartition(files).write.parquet(log)
        assert streams._several(spark, log) == {"maxFilesPerTrigger": bound}


def test_rows_of_one_file_are_dealt_over_training_tasks(spark):
    fields = {f.name: F.lit(None).cast(f.dataType) for f in TRANSACTIONS.silver.fields}
    odd = F.col("id") % 2 == 1
    fields |= {"amount": F.col("id").cast("double"), "is_fraud": odd.cast("int"), "geo_lat": F.when(~odd, F.lit(1.0))}
    rows = spark.range(0, 200, 1, 1).select(*[value.alias(name) for name, value in fields.items()])
    model = scoring.train_fraud_model(rows, per_task=10)
    assert model.transform(scoring.fraud_features(rows)).filter("prediction <> is_fraud").count() == 0


def test_training_set_reads_the_payments_once(spark):
    read = QUERIES["training_set"].run(spark, SF_DIR).inputFiles()
    assert read and not any("lineitem" in name for name in read)
