import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.limit(5).collect()
    assert len(rows) > 0 and "will_visit" in df.columns and len(df.columns) == 86


def test_registry_consistency():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_prepare_plan_has_no_python_and_prunes(spark):
    plan = E.queries()["prepare_frame"](spark, "/root/testdata/sf0.001")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    # the events scan reads only the columns the adapter needs
    assert "event_type" not in plan.split("ReadSchema: struct<event_id")[1].split(">")[0]
