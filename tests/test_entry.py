import __spark_entry__ as E


def test_entry_schema_and_interval(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["m", "rmse", "lo", "hi", "n_features"]
    r = df.first()
    assert r["m"] > 0 and r["lo"] <= r["rmse"] <= r["hi"]
    # the planted noise is uniform on [-1, 1): its RMSE is 1/sqrt(3)
    assert abs(r["rmse"] - 3 ** -0.5) < 0.05


def test_every_query_is_callable():
    qs = E.queries()
    assert len(qs) >= 200 and all(callable(f) for f in qs.values())
