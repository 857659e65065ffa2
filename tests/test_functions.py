import datetime
import math

import pytest
from pyspark.sql import functions as F, types as T

from flowgauge.functions import epoch, geo, named, text
from flowgauge.sources import schemas


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("value, unit, expected", [
    (1499, "ms", 1), (1500, "ms", 2), (-1500, "ms", -1), (-1501, "ms", -2), (0, "ms", 0),
    (1_577_836_800_123_456, "s", 1_577_836_800), (499_999, "s", 0), (500_000, "s", 1),
    (9_007_199_254_740_993, "ms", 9_007_199_254_741),
])
def test_rescale_rounds_half_up_exactly(spark, value, unit, expected):
    assert one(spark, epoch.rescale_epoch("x", "us", unit), x=value) == expected


def test_rescale_nanosecond_sample(spark):
    assert one(spark, epoch.rescale_epoch("x", "ns", "us"), x=1579006137039000000) == 1579006137039000


def test_rescale_to_finer_unit(spark):
    assert one(spark, epoch.rescale_epoch("x", "s", "us"), x=3) == 3_000_000


def test_timestamp_from_ms_drops_the_fraction(spark):
    got = one(spark, epoch.timestamp_from_ms_floored("x").cast("string"), x=1_577_836_800_999)
    assert got == "2020-01-01 00:00:00"
    assert one(spark, epoch.timestamp_from_ms_floored("x").cast("string"), x=-1) == "1969-12-31 23:59:59"


def test_text_to_epoch_ms(spark):
    assert one(spark, epoch.text_to_epoch_ms("x"), x="2020-01-01 00:00:01") == 1_577_836_801_000
    assert one(spark, epoch.text_to_epoch_ms("x"), x="soon") is None


def test_truncating_division(spark):
    assert one(spark, epoch.truncating_div("x", 1_000_000), x=-1_999_999) == -1
    assert one(spark, epoch.floor_div("x", 1_000_000), x=-1_999_999) == -2


def test_interval_seconds():
    assert epoch.interval_seconds("10 minutes 3 seconds") == 603
    assert epoch.interval_seconds("1 second") == 1


@pytest.mark.parametrize("a, b, km", [
    ((0, 0), (0, 0), 0.0), ((0, 0), (0, 180), math.pi * 6371), ((90, 0), (-90, 0), math.pi * 6371),
    ((-37.8136, 144.9631), (-33.8688, 151.2093), 713.4),
])
def test_distance(spark, a, b, km):
    got = one(spark, geo.haversine_km("a", "b", "c", "d"), a=float(a[0]), b=float(a[1]), c=float(b[0]), d=float(b[1]))
    assert got == pytest.approx(km, abs=0.1)


def test_distance_of_nearly_opposite_points_is_a_number(spark):
    got = one(spark, geo.haversine_km("a", "b", "c", "d"), a=0.1, b=0.0, c=-0.1, d=180.0)
    assert not math.isnan(got)


def test_number_after_name(spark):
    body = '{"sensor_0" : 12.5, "sensor_01": 3, "sensor_1":"x"}'
    assert one(spark, text.number_after_name("b", "sensor_0"), b=body) == 12.5
    assert one(spark, text.number_after_name("b", "sensor_1"), b=body) is None


def test_json_value_of_bad_text(spark):
    assert one(spark, text.json_value("b", "$.a"), b="{no json") is None
    assert one(spark, text.json_value("b", "$.a"), b='{"a": "x"}') is None
    assert one(spark, text.json_value("b", "$.a"), b='{"a": 2.5}') == 2.5


def test_digit_runs(spark):
    df = spark.createDataFrame([("a 1234567890 b 123 c 99999999999",), ("none",)], "v string")
    assert [r["run"] for r in text.digit_runs(df, "v").collect()] == ["1234567890", "99999999999"]


def test_replace_whole_text_with_line_breaks(spark):
    assert one(spark, text.replace_whole("v", "[$1]"), v="a\nb") == "[a\nb]"
    assert one(spark, text.replace_whole("v", "x"), v="") == "x"


def test_feature_text_and_back(spark):
    df = spark.createDataFrame([(1, 2.5)], "a int, b double").withColumn("f", text.feature_text(["a", "b"]))
    row = df.withColumn("n", text.feature_numbers("f")).first()
    assert (row["f"], row["n"]) == ("1, 2.5", [1.0, 2.5])
    assert one(spark, text.feature_numbers("f"), f="1, x") == [1.0, None]


def test_stub_is_repeatable_with_keys_and_in_range(spark):
    df = spark.range(200).select("id", text.stub_result(["id"]).alias("k"), text.stub_result(seed=3).alias("r"))
    rows = df.collect()
    assert {r["k"] for r in rows} == {0, 1} and {r["r"] for r in rows} == {0, 1}
    assert rows == df.collect()


def test_log_axis(spark):
    assert one(spark, text.log_axis("x"), x=100.0) == 2.0
    assert one(spark, text.log_axis("x"), x=0.0) is None


def test_avro_schema_round_trip():
    text_ = schemas.struct_to_avsc(schemas.READING_ENHANCED, "SensorReading")
    assert schemas.avsc_to_struct(text_) == schemas.READING_ENHANCED


def test_avro_unions_arrays_and_times():
    got = schemas.avsc_to_struct("""{"type": "record", "name": "r", "fields": [
        {"name": "a", "type": ["null", "long"]},
        {"name": "b", "type": {"type": "array", "items": "string"}},
        {"name": "c", "type": {"type": "long", "logicalType": "timestamp-micros"}}]}""")
    assert got == T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.ArrayType(T.StringType())),
                                T.StructField("c", T.TimestampType())])


def test_named_functions_list_and_drop(spark):
    named.register_builtin(spark)
    assert len(named.find_functions(spark, "havetokm")) == 1
    assert spark.sql("SELECT HAVETOKM(0D, 0D, 0D, 90D) AS d").first()["d"] == pytest.approx(math.pi * 6371 / 2)
    named.drop_function(spark, "HAVETOKM")
    assert named.find_functions(spark, "HAVETOKM") == []
    named.drop_function(spark, "HAVETOKM")


def test_python_function_by_name(spark):
    named.create_python_function(spark, "plus_one", lambda x: x + 1, "int")
    assert spark.sql("SELECT plus_one(2) AS r").first()["r"] == 3
    named.drop_function(spark, "plus_one")


def test_naive_keeps_the_wall_clock(spark):
    got = one(spark, epoch.naive(F.lit("2024-01-01 10:00:00").cast("timestamp")))
    assert got == datetime.datetime(2024, 1, 1, 10)
