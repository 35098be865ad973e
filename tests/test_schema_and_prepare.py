import pytest
from pyspark.sql import functions as F

from plover.config import DatasetSpec, Interaction, ListFeature, default_dataset_spec
from plover.operators import schema as S
from plover.operators.features import assemble_bundle, prepare_frame

LAKE_COLS = ("row_id long, user_id string, location_id string, location_category_encoded string, "
             "location_avg_rating double, location_popularity int, location_vibe_tags string, "
             "user_total_visits int, user_personal_preferences string, will_visit double, split string")


def lake_rows(spark, rows):
    return spark.createDataFrame(rows, LAKE_COLS)


def one_row(target=1.0, rid=1, split="train"):
    return (rid, "u", "g", "[0, 1]", 4.5, 10, "[1, 0, 1]", 3, "[0.5, 0.25]", target, split)


def test_rename_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = S.apply_column_rename(df, {"a": "x", "zz": "y"})
    assert out.columns == ["x", "b"]


def test_conform_errors_and_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, extra int")
    assert S.enforce_canonical_schema(df, ["a", "c"]).columns == ["a", "c"]
    assert S.enforce_canonical_schema(df, []).columns == ["c", "a", "extra"]
    with pytest.raises(S.SchemaError) as e:
        S.enforce_canonical_schema(df, ["z", "b", "a"])
    assert "['b', 'z']" in str(e.value)


def test_align_features_fill_and_drop(spark):
    df = spark.createDataFrame([(1, 2.0, 9.0, 1)], "k int, a double, extra double, y int")
    out = S.align_features(df, ["b", "a"], keep=["k", "y"])
    assert out.columns == ["k", "y", "b", "a"]
    assert tuple(out.first()) == (1, 1, 0.0, 2.0)


def test_flatten():
    assert S.flatten_dict({"candidate": {"name": "x", "params": {"lr": 0.1}}}) == \
        {"candidate.name": "x", "candidate.params.lr": 0.1}


def test_flatten_struct_columns(spark):
    df = spark.createDataFrame([((1, (2, 3)),)], "s struct<a:int,b:struct<c:int,d:int>>")
    out = S.flatten_struct_columns(df)
    assert out.columns == ["s.a", "s.b.c", "s.b.d"] and tuple(out.first()) == (1, 2, 3)


def test_prepare_frame_shape_and_values(spark):
    df = lake_rows(spark, [one_row(0.9)])
    out = prepare_frame(df, default_dataset_spec(), key_columns=["row_id"])
    feats = [c for c in out.columns if c not in ("row_id", "will_visit")]
    assert len(feats) == 84
    r = out.first().asDict()
    assert r["will_visit"] == 0  # truncation, as an int cast
    assert r["cat_enc_1"] == 1.0 and r["cat_enc_2"] == 0.0
    assert r["vibe_2"] == 1.0 and r["user_pref_1"] == 0.25
    assert r["pref_x_vibe_0"] == 0.5 * 1.0
    # position 2 pairs user_pref_10 with vibe_10 (text order), both padded zeros
    assert r["pref_x_vibe_2"] == 0.0
    assert "split" not in out.columns and "user_id" not in out.columns


def test_prepare_frame_null_target_fails(spark):
    df = lake_rows(spark, [one_row(None)])
    with pytest.raises(Exception):
        prepare_frame(df, default_dataset_spec()).collect()


def test_prepare_frame_missing_canonical(spark):
    df = lake_rows(spark, [one_row()]).drop("location_vibe_tags")
    with pytest.raises(S.SchemaError):
        prepare_frame(df, default_dataset_spec())


def test_prepare_zero_rows(spark):
    df = lake_rows(spark, [])
    assert prepare_frame(df, default_dataset_spec()).count() == 0


def test_no_canonical_keeps_extra_numeric(spark):
    spec = DatasetSpec(target_column="y", list_features=[ListFeature("l", 2, "p")],
                       interactions=[Interaction("p", "p", "sq")])
    df = spark.createDataFrame([(1.0, "[2, 3]", 1, "txt")], "time double, l string, y int, note string")
    out = prepare_frame(df, spec)
    assert out.columns == ["time", "y", "note", "p_0", "p_1", "sq_0", "sq_1"]
    assert tuple(out.first()) == (1.0, 1, "txt", 2.0, 3.0, 4.0, 9.0)


def test_bundle_alignment(spark):
    spec = default_dataset_spec()
    train = lake_rows(spark, [one_row(1.0, 1), one_row(0.0, 2)])
    val = lake_rows(spark, [one_row(1.0, 3, "eval")])
    b = assemble_bundle(train, val, spec, ["row_id"])
    assert len(b.feature_columns) == 84
    assert b.val.columns == ["row_id", *b.feature_columns, "will_visit"]
