import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_golden_counts(spark):
    from barloom.plans.views import view

    sf = "/root/testdata/sf0.001"
    assert view(spark, sf, "raw_bars").count() == 6000
    assert view(spark, sf, "clean_bars").count() == 4756
    assert view(spark, sf, "listings").count() == 200
