"""Ledger lines without an invoice: one pass over the ledger, lost references apart."""

from ledgerline.operators import joins


def test_lines_are_kept_in_one_pass(spark):
    columns = "transaction_id string, invoice_reference string"
    rows = [("t1", "i1"), ("t2", None), ("t3", "gone"), ("t3", "gone"), (None, None), ("t5", None), ("t6", "i2")]
    bank = spark.createDataFrame(rows, columns)
    # an invoice whose id looks like the key of a line without a reference
    invoices = spark.createDataFrame([("i1",), ("i2",), ("i2",), (None,), ("no reference: t5",)], "invoice_id string")
    found = joins.unmatched_by_reference(bank, invoices)
    assert found.columns == bank.columns
    expected = [(None, None), ("t2", None), ("t3", "gone"), ("t3", "gone"), ("t5", None)]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan  # the ledger was read once for each of two parts
