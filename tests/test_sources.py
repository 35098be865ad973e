import os
import time

import pytest
from pyspark.sql import functions as F

from plover.sources import readers as RD
from plover.sources import sinks as SK


def test_csv_na_tokens_and_lists(spark, scratch):
    path = os.path.join(scratch, "in.csv")
    with open(path, "w") as fh:
        fh.write('id,rating,tags\n1,NA,"[1, 0]"\n2,4.5,"[0, 1]"\n3,null,\n')
    df = RD.read_csv(spark, path, "id long, rating double, tags string")
    rows = df.orderBy("id").collect()
    assert rows[0]["rating"] is None and rows[1]["rating"] == 4.5 and rows[2]["rating"] is None
    assert rows[0]["tags"] == "[1, 0]"


def test_latest_file_and_greatest_key(spark, scratch):
    for i, name in enumerate(["b.parquet", "a.parquet", "c.parquet"]):
        spark.createDataFrame([(i,)], "v int").coalesce(1).write.parquet(os.path.join(scratch, "tmp" + name))
        part = [f for f in os.listdir(os.path.join(scratch, "tmp" + name)) if f.endswith(".parquet")][0]
        os.rename(os.path.join(scratch, "tmp" + name, part), os.path.join(scratch, name))
    now = time.time()
    os.utime(os.path.join(scratch, "b.parquet"), (now, now - 10))
    os.utime(os.path.join(scratch, "a.parquet"), (now, now))
    os.utime(os.path.join(scratch, "c.parquet"), (now, now - 20))
    latest = RD.resolve_latest_file(spark, scratch)
    assert latest.endswith("/a.parquet")
    assert RD.resolve_greatest_key(spark, scratch).endswith("/c.parquet")
    direct = os.path.join(scratch, "b.parquet")
    assert RD.resolve_latest_file(spark, direct) == direct
    with pytest.raises(RD.SourceError):
        RD.resolve_latest_file(spark, os.path.join(scratch, "nothing-here"))


def test_latest_drop_reads_the_whole_newest_write(spark, scratch):
    d = os.path.join(scratch, "drops")
    spark.range(0, 40, numPartitions=4).write.parquet(os.path.join(d, "first"))
    time.sleep(0.05)
    # Eight tasks for three rows: the write also leaves empty part-files.
    spark.range(100, 103, numPartitions=8).write.parquet(os.path.join(d, "second"))
    got = sorted(r["id"] for r in RD.read_latest_drop(spark, d, recursive=True).collect())
    assert got == [100, 101, 102]
    # A single non-Spark file is read as is.
    single = os.path.join(scratch, "one.parquet")
    spark.range(7, 8).coalesce(1).write.parquet(os.path.join(scratch, "tmp1"))
    part = [f for f in os.listdir(os.path.join(scratch, "tmp1")) if f.endswith(".parquet")][0]
    os.rename(os.path.join(scratch, "tmp1", part), single)
    assert [r["id"] for r in RD.read_latest_drop(spark, single).collect()] == [7]


def test_choose_source():
    assert RD.choose_source(parquet="x").kind == "parquet"
    assert RD.choose_source(train_csv="a", val_csv="b").kind == "csv"
    for kw in [{}, {"parquet": "x", "train_csv": "a"}, {"train_csv": "a"}]:
        with pytest.raises(RD.SourceError):
            RD.choose_source(**kw)


def test_fallback_chain(spark, scratch):
    assert RD.read_table_or_none(spark, "no_such_db.no_such_table") is None
    d = os.path.join(scratch, "lake")
    spark.createDataFrame([(1,)], "v int").write.parquet(os.path.join(d, "x"))
    assert RD.load_with_fallback(spark, "no_such_table", d).count() == 1
    with pytest.raises(RD.SourceError):
        RD.load_with_fallback(spark, None, None)


def test_split_sink_and_dated_copy(spark, scratch):
    df = spark.createDataFrame([(1, "train"), (2, "val")], "k int, split string")
    out = SK.write_splits(df, os.path.join(scratch, "splits"))
    assert spark.read.parquet(out).count() == 2
    path = SK.write_dated_copy(df, os.path.join(scratch, "sets"), "2024-01-02")
    assert path.endswith("run_date=2024-01-02") and spark.read.parquet(path).count() == 2
    assert SK.model_path("/m", "x", False) == "/m/_rejected/x"


def test_scratch_under_checkpoint_dir(spark):
    p = SK.scratch_path(spark, "t")
    assert spark.sparkContext.getCheckpointDir().rstrip("/") in p


def test_loaders_read_whole_drops(spark, scratch):
    from plover.sources import readers as R
    rows = spark.range(100).select("id", F.when(F.col("id") < 70, "train").otherwise("eval").alias("f"))
    rows.repartition(4).write.parquet(f"{scratch}/drop/2024-02-01")
    spark.range(3).write.parquet(f"{scratch}/drop/2024-01-01")  # written later, smaller key
    assert R.load_with_fallback(spark, None, f"{scratch}/drop").count() == 100
    assert R.read_latest_drop(spark, f"{scratch}/drop/2024-02-01").count() == 100


def test_csv_without_schema_types_numbers(spark, scratch):
    from plover.sources import readers as R
    with open(f"{scratch}/a.csv", "w") as f:
        f.write('a,b,c,d\n1,1.5,"[1, 2]",x\nNA,2,NULL,3\n')
    got = R.read_csv(spark, f"{scratch}/a.csv")
    assert dict(got.dtypes) == {"a": "bigint", "b": "double", "c": "string", "d": "string"}
    assert [r.a for r in got.collect()] == [1, None]


def test_shuffled_write_does_not_depend_on_partitions(spark, scratch):
    import glob
    from pyspark.sql import functions as F
    from plover.functions.exprs import seeded_hash
    from plover.sources import sinks as SK
    df = spark.range(5000).withColumn("v", F.col("id") * 2)
    want = [r["id"] for r in df.orderBy(seeded_hash(7, "id"), "id").collect()]
    for parts, rows in ((3, df), (11, df.repartition(6, "v"))):
        path = SK.write_shuffled(rows, f"{scratch}/s{parts}", ["id"], seed=7, parts=parts)
        back = SK.read_shuffled(spark, path)
        assert back.columns == ["id", "v", "position"]
        assert [r["id"] for r in back.orderBy("position").collect()] == want
        assert [r["position"] for r in back.orderBy("position").collect()] == list(range(5000))
        files = sorted(glob.glob(f"{path}/part-*"))
        assert len(files) == parts and [r["id"] for f in files for r in spark.read.parquet(f).collect()] == want
    empty = SK.read_shuffled(spark, SK.write_shuffled(df.limit(0), f"{scratch}/none", ["id"]))
    assert empty.count() == 0


def test_concurrent_writers_claim_different_versions(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    from plover.sources import sinks as SK
    with ThreadPoolExecutor(20) as pool:
        got = list(pool.map(lambda _: SK.claim_version(spark, f"{scratch}/claims", "Will/Visit"), range(20)))
    assert sorted(got) == list(range(1, 21))
    assert SK.claim_version(spark, f"{scratch}/claims", "Will/Visit", least=40) == 40
    assert SK.claim_version(spark, f"{scratch}/claims", "other") == 1


def test_next_version_claims(spark, scratch):
    from plover.operators import registry as R
    versions = spark.createDataFrame([("M", 3)], "name string, version int")
    decision = spark.createDataFrame([("r1", "c", 0.7, True)], "run_id string, candidate_name string, f1 double, register boolean")
    assert R.next_version(versions, decision, "M").first()["version"] == 4
    assert [R.next_version(versions, decision, "M", f"{scratch}/c").first()["version"] for _ in range(2)] == [4, 5]
    assert R.next_version(versions, decision.limit(0), "M", f"{scratch}/c").isEmpty()
