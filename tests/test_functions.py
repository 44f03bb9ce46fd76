import pytest
from pyspark.sql import functions as F

from tvtrail.functions import labels, regions, text, times
from tvtrail.functions.regions import MOBILE_AREAS, TELECOM_PREFIXES, UNICOM_AREAS, UNICOM_PHONES


def column(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_telecom_prefixes(spark):
    users = [f"{prefix}9" for _, prefixes in TELECOM_PREFIXES for prefix in prefixes]
    want = []
    for user in users:
        want.append(next(region for region, prefixes in TELECOM_PREFIXES
                         if any(user.startswith(p) for p in prefixes)))
    assert column(spark, users, regions.telecom_region) == want
    assert dict(zip(users, want))["YX9"] == "14302" and dict(zip(users, want))["JH9"] == "14310"
    assert column(spark, ["", "Y", "zz1", "0731", None], regions.telecom_region) == ["14301"] * 5


def test_mobile_and_unicom(spark):
    codes = [*MOBILE_AREAS, *MOBILE_AREAS.values(), "x", "", None]
    want = [*MOBILE_AREAS.values(), *MOBILE_AREAS.values(), "14301", "14301", "14301"]
    assert column(spark, codes, regions.mobile_region) == want
    phones = [f"{p}55" for p in UNICOM_PHONES] + ["073155"]
    want = [UNICOM_AREAS[a] for a in UNICOM_PHONES.values()] + ["14301"]
    assert column(spark, phones, lambda u: regions.unicom_region(u, F.lit(None).cast("string"))) == want
    assert column(spark, ["073455"], lambda u: regions.unicom_region(u, F.lit(" 0009 "))) == ["14331"]
    assert column(spark, ["073455"], lambda u: regions.unicom_region(u, F.lit(""))) == ["14304"]


def test_major_version(spark):
    assert column(spark, ["A.1.2.3", "1.2", None, "a.b.c.", "...x", "a.b.c.d.e"], text.major_version) == [
        "A.1.2", "", "", "a.b.c", "..", "a.b.c"]


def test_blank_and_choice(spark):
    assert column(spark, [None, "", " \t", "null", "NULL", "Null", "x"], text.blank_to_empty) == [
        "", "", "", "", "", "Null", "x"]
    assert column(spark, [None, "", "n"], lambda v: text.choose_new(F.lit("o"), v)) == ["o", "o", "n"]


def test_search_key_name(spark):
    def name(media, word):
        return column(spark, [media], lambda m: text.search_key_name(m, F.lit(word)))[0]

    assert name("abcdef", "xyz") == "abc" and name(" ab ", "wxyz") == "ab"
    assert name("", "x") == name(None, "x") == name("abc", "") == ""


def test_times(spark):
    values = ["2017-10-27T19:01:43+0800", "2017-10-27T19:01:43", "2017-13-27T19:01:43+0800", "junk", None]
    assert column(spark, values, times.device_time) == ["20171027110143", None, None, None, None]
    assert column(spark, values[:1], lambda v: times.device_time(v, 30)) == ["20171027113143"]
    assert column(spark, ["2017-10-27T19:01:43.120+0800"], times.device_time_ms) == ["20171027110143120"]
    assert column(spark, ["20180101235959"], lambda v: times.seconds_between(v, F.lit("20180102000030"))) == [31]
    assert column(spark, ["01:02:03"], times.clock_seconds) == [3723]
    assert column(spark, ["000000"], lambda v: times.clock_duration(v, F.lit("000030"))) == [30]
    assert column(spark, ["20240228"], lambda v: times.plus_days(v, 2)) == ["20240301"]
    assert column(spark, ["20240228235959"], lambda v: times.plus_seconds(v, 1)) == ["20240229000000"]
    assert times.halo_days("20240301") == ["20240229", "20240301", "20240302"]


def test_device_time_follows_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert column(spark, ["2017-10-27T19:01:43+0800"], times.device_time) == ["20171027190143"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_labels(spark):
    assert labels.check_platform("HNYD") == "HNYD"
    with pytest.raises(ValueError):
        labels.check_platform("XX")
    assert column(spark, ["apk", "c3", None], lambda s: labels.report_source(F.lit("HNDX"), s)) == [
        "HNDX_APK", "HNDX_C3", "HNDX_ALL"]
    with pytest.raises(Exception, match="no report source"):
        column(spark, ["sdk"], lambda s: labels.report_source(F.lit("HNDX"), s))
    assert column(spark, ["0x04", "0x05", "0x03", "0x06"], labels.max_seconds) == [14400, 14400, 28800, 28800]
    assert column(spark, ["0x100", "0x01", "0x07"], labels.is_active_record) == [False, False, True]
