"""Deliveries may be compressed: they land byte for byte and are read by their header."""

import hashlib
from pathlib import Path

from ledgerline.registry import receive_invoices
from ledgerline.sources import bronze, landing


def write_tables(spark, tmp_path):
    line = "1L l_orderkey, 1L l_linenumber, 1L l_partkey, 1L l_suppkey, 3.0D l_quantity, 90.5D l_extendedprice, 0.1D l_discount"
    rest = "0.05D l_tax, 'N' l_returnflag, 'O' l_linestatus, timestamp'1998-05-05 00:00:00' l_shipdate"
    spark.sql(f"SELECT {line}, {rest}").write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_compressed_delivery_lands_as_it_is(spark, tmp_path):
    rows = spark.range(25).selectExpr("string(id) as key", "concat('a, \"b\" ', id) as text").coalesce(1)
    options = {**bronze.DELIVERY, "maxRecordsPerFile": 10}
    bronze.write_csv(rows, f"{tmp_path}/in.csv", **options)
    sent = sorted(Path(tmp_path, "in.csv").glob("*.csv.gz"))
    assert len(sent) == 3
    entries = bronze.land_bronze(spark, f"{tmp_path}/in.csv", f"{tmp_path}/b", "other", "2001-01-01")
    assert sorted(e["sha256"] for e in entries) == sorted(hashlib.sha256(p.read_bytes()).hexdigest() for p in sent)
    found = landing.verify(spark, f"{tmp_path}/b", "other").collect()
    assert len(found) == 3 and all(r.sha256 == r.sha256_now and r.length == r.length_now for r in found)
    back = bronze.read_bronze(spark, f"{tmp_path}/b", "other")
    assert back.columns == ["key", "text", "ingested_date"]
    assert {tuple(r) for r in back.drop("ingested_date").collect()} == {tuple(r) for r in rows.collect()}


def test_received_invoices_are_compressed(spark, tmp_path):
    tables = write_tables(spark, tmp_path)
    path = receive_invoices(spark, tables, str(tmp_path))
    names = bronze.data_files(spark, path)
    assert names and all(name.endswith(".csv.gz") for name in names)
