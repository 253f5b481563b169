"""Edge tests of the scalar column functions on literal frames."""
import datetime as dt

from pyspark.sql import functions as F

from tarmac.functions import columns as C


def one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_dest_code(spark):
    got = one(spark, C.dest_code("r"), [("MUNICH (muc)",), ("NO CODE",), ("A (B) (ccc) ",), (None,)], "r string")
    assert got == ["MUC", "NO CODE", "CCC", None]


def test_carrier_code(spark):
    assert one(spark, C.carrier_code("f"), [("LH 1234",), ("FR",)], "f string") == ["LH", "UNKNOWN"]


def test_time_from_status_and_guard(spark):
    rows = [("Departed 01:05", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 23, 10)),
            ("DEPARTED  12:30", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 12, 0)),
            ("Departed 25:99", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 12, 0)),
            ("Cancelled", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 12, 0))]
    df = spark.createDataFrame(rows, "s string, d date, p timestamp_ntz")
    a = C.combine_date_time("d", C.time_from_status("s"))
    got = [r[0] for r in df.select(C.midnight_guard(a, F.col("p"))).collect()]
    assert got == [dt.datetime(2024, 1, 2, 1, 5), dt.datetime(2024, 1, 1, 12, 30), None, None]


def test_parse_date_multi(spark):
    got = one(spark, C.parse_date_multi("t"), [("26/04/2026",), ("2026-04-26",), ("junk",)], "t string")
    assert got == [dt.date(2026, 4, 26), dt.date(2026, 4, 26), None]


def test_rollover_and_clip(spark):
    got = one(spark, C.delay_clipped(C.rollover_minutes("d")), [(-721.0,), (-720.0,), (-5.0,), (721.0,), (None,)],
              "d double")
    assert got == [719.0, 0.0, 0.0, 721.0, None]


def test_day_part_edges(spark):
    got = one(spark, C.day_part("h"), [(4,), (5,), (11,), (12,), (16,), (17,), (21,), (22,), (None,)], "h int")
    assert got == ["night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", None]


def test_delay_band_right_closed(spark):
    got = one(spark, C.delay_band("d"), [(0.0,), (0.5,), (15.0,), (15.5,), (30.0,), (60.0,), (61.0,), (None,)], "d double")
    assert got == ["early/on-time", "1-15", "1-15", "15-30", "15-30", "30-60", "60+", None]


def test_histogram_band_outside_is_null(spark):
    got = one(spark, C.delay_histogram_band("d"), [(-200.0,), (-199.0,), (0.0,), (1000.0,), (1001.0,)], "d double")
    assert got == [None, "< 0", "0", "> 200", None]


def test_late_flags(spark):
    df = spark.createDataFrame([(15.0,), (16.0,), (None,)], "d double")
    a = [r[0] for r in df.select(C.late_flag_nullable("d")).collect()]
    b = [r[0] for r in df.select(C.late_flag_strict("d")).collect()]
    c = [r[0] for r in df.select(C.late_flag_inclusive("d")).collect()]
    assert a == [0.0, 1.0, None] and b == [0, 1, 0] and c == [1, 1, 0]


def test_encoders_unknown(spark):
    df = spark.createDataFrame([("A",), ("Z",)], "c string")
    oh = df.select(*C.one_hot("c", ["A", "B"], "x")).collect()
    assert [tuple(r) for r in oh] == [(1, 0), (0, 0)]
    assert [r[0] for r in df.select(C.ordinal("c", ["A", "B"])).collect()] == [0, -1]


def test_format_p(spark):
    got = one(spark, C.format_p("p"), [(0.5,), (0.0123456,), (0.00001234,)], "p double")
    assert got == ["0.5", "0.0123", "1.23e-05"]


def test_effect_labels(spark):
    got = one(spark, C.rho_label("r"), [(-0.05,), (0.2,), (-0.45,), (0.6,), (0.9,)], "r double")
    assert got == ["negligible", "weak", "moderate", "strong", "very strong"]


def test_haversine_zero_at_origin(spark):
    from tarmac import schemas as S
    got = one(spark, C.haversine_km("a", "b"), [(S.ORIGIN_LAT, S.ORIGIN_LON)], "a double, b double")
    assert abs(got[0]) < 1e-9
