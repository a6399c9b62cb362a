"""The lead table derived from customers."""

from pathlib import Path

from leadlake.plans import fixtures


def test_leads_are_derived_by_several_tasks(spark, tmp_path, monkeypatch):
    """A file of customers is one task however many leads come of it, so customers are spread first; repeated and null keys stay."""
    keys = [(i,) for i in range(1, 40)] + [(7,), (None,)]
    spark.createDataFrame(keys, "c_custkey bigint").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(fixtures, "CUSTOMERS_PER_TASK", 10)
    found = fixtures.leads(spark, str(tmp_path))
    whole = fixtures.leads_from(spark, fixtures.table(spark, str(tmp_path), "customer"))
    assert found.count() == whole.count() == len(keys)
    assert found.exceptAll(whole).isEmpty()
    landed = Path(fixtures._LANDED[spark.sparkContext.applicationId, str(tmp_path)])
    assert len(list(landed.glob("part-*.parquet"))) > 1
