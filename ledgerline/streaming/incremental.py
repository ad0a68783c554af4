"""Daily ingest as a stream of landing manifests: days with a new manifest are cleaned and replaced in the target."""

from ledgerline.operators.silver import (
    silver_bank_transactions,
    silver_invoices,
    silver_suppliers,
)
from ledgerline.sources.bronze import read_bronze

CLEANERS = {
    "sa_invoices": silver_invoices,
    "sa_suppliers": silver_suppliers,
    "sa_bank_transactions": silver_bank_transactions,
}


def landing_stream(spark, root, dataset):
    """New manifests: an entry per landed file, with its day. No landed file is opened to find out what is new."""
    schema = "value string, ingested_date string"
    return spark.readStream.schema(schema).format("text").load(f"{root}/{dataset}/manifests")


def bronze_incremental(spark, root, dataset, target, checkpoint):
    """Clean every day that has an unseen manifest into ``target`` (Parquet by day) and stop.

    A batch reads the days it touches whole and overwrites just those partitions, so a rerun after a lost
    executor, a restart, or a second landing on the same day leaves each day exactly as Bronze has it.
    The checkpoint folder is the ingest log.
    """

    def replace_days(batch, batch_id):
        # one row per landing day of the batch
        days = sorted(row.ingested_date for row in batch.select("ingested_date").distinct().collect())
        if not days:
            return
        cleaned = CLEANERS[dataset](
            read_bronze(batch.sparkSession, root, dataset, days), keep=["ingested_date"]
        )
        (
            cleaned.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("ingested_date")
            .parquet(target)
        )

    query = (
        landing_stream(spark, root, dataset)
        .writeStream.foreachBatch(replace_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
