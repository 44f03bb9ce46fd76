import pytest
from pyspark.sql import functions as F

from tvtrail.sources import app_lines, files, records

TIME = "2024-01-01T08:01:00+0000"
LIVE = f"0x03|MACX|U1|003|{TIME}||http|CH1|News|0|watch|0|||"
INIT = f"0x01|MAKER|MACX|M1|A.1.2.3|4.4|003|10.0.0.1|ACC1|U1|U1|android|{TIME}|HNYD|07311|v1|||"


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def parsed(spark, *values):
    return records.parse_mobile(lines(spark, *values)).collect()


def test_live_record(spark):
    (r,) = parsed(spark, LIVE)
    assert (r.state, r.user_id, r.create_time, r.play, r.channel_id) == ("0x03", "U1", "20240101080100", True, "CH1")
    (r,) = parsed(spark, LIVE.replace("watch|0", "watch|1"))
    assert r.play is False


def test_packed_line_and_prefix(spark):
    rows = parsed(spark, LIVE + "\\x0A" + INIT, "2024-01-01 06:50:19 - 10.0.0.1 - " + INIT)
    assert sorted(r.state for r in rows) == ["0x01", "0x01", "0x03"]
    assert {r.regionid for r in rows if r.state == "0x01"} == {"14303"}
    assert {r.manufacturers for r in rows if r.state == "0x01"} == {"MAKER"}


@pytest.mark.parametrize("bad", ["BAD", "2024-13-01T08:00:00+0000", "2024-02-30T08:00:00+0000", "2024-01-01", ""])
def test_bad_times_are_dropped(spark, bad):
    assert parsed(spark, LIVE.replace(TIME, bad), INIT.replace(TIME, bad)) == []


def test_short_power_on_is_rejected(spark):
    assert parsed(spark, "|".join(INIT.split("|")[:14])) == []


def test_fallbacks(spark):
    vod = ["0x04", "M", "U1", "003", TIME, *[""] * 18]
    vod[17], vod[22] = "play", "CH9"
    rows = parsed(spark, "|".join(vod), "|".join(vod[:22]), f"0x77|M|U2|003|{TIME}", "garbage")
    assert sorted((r.state, r.user_id) for r in rows) == [("0x04", "U1"), ("0x100", "U1"), ("0x100", "U2")]


def test_long_lines_are_whole(spark):
    packed = "\\x0A".join(LIVE.replace("U1", f"U{i}") for i in range(5000))
    assert records.parse_mobile(lines(spark, packed)).select("user_id").distinct().count() == 5000


def test_parsing_takes_a_record_apart_once(spark):
    plan = records.parse_mobile(lines(spark, LIVE)).where("state = '0x03'").select("user_id", "channel_id")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 2


def test_optional_and_halo_scan(spark, tmp_path):
    for day in ("20240101", "20240102", "20240104"):
        lines(spark, day).write.text(f"{tmp_path}/sdk_0x07/dt={day}")
    codes = ["0x07", "0x09"]
    with pytest.raises(FileNotFoundError, match="20240103"):  # orders may be absent, a day may not
        files.read_log_days(spark, str(tmp_path), "20240102", codes)
    got = files.read_log_days(spark, str(tmp_path), "20240102", codes, allow_missing=True)
    assert sorted(r.value for r in got.collect()) == ["20240101", "20240102"]
    assert files.read_days(spark, str(tmp_path), codes, ["20240101"]).count() == 1
    assert files.read_lines(spark, [f"{tmp_path}/none/*"], optional=True).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_lines(spark, [f"{tmp_path}/none"]).count()


def test_partition_read_prunes(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = [(1, "20240101", "HNYD", "sdk"), (2, "20240102", "HNYD", "sdk"), (3, "20240102", "HNDX", "apk")]
    spark.createDataFrame(rows, "v int, dt string, platform string, source_type string").write.partitionBy(
        "dt", "platform", "source_type").parquet(path)
    got = files.read_partition(spark, path, "20240102", "HNYD")
    assert [r.v for r in got.collect()] == [2] and dict(got.dtypes)["dt"] == "string"
    assert "PartitionFilters: [isnotnull" in got._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options():
    got = files.jdbc_options({"url": "jdbc:x"}, "select 1", "id", (1, 900), 8, 50)
    assert got["dbtable"] == "(select 1) t" and got["partitionColumn"] == "id" and got["numPartitions"] == "8"
    assert got["fetchsize"] == "50" and (got["lowerBound"], got["upperBound"]) == ("1", "900")
    with pytest.raises(ValueError):
        files.jdbc_options({}, "q", "id")


def test_online_lines(spark):
    raw = lines(spark, '{"uuid":"U1","apk_version":"A.1.2"}', "not json", '{"uuid":" "}', '{"apk_version":"x"}', "")
    assert [tuple(r) for r in app_lines.parse_online(raw).collect()] == [("U1", "A.1.2")]
    with pytest.raises(ValueError):
        app_lines.online_regions(app_lines.parse_online(raw), "HNXX")


def test_app_vod_lines(spark):
    raw = lines(
        spark,
        r'{\"user_id\":\"U1\",\"play_start_time\":\"2024-01-02 10:00:05\",\"sndlvl_name\":\"a:b\",\"cat_id\":\"1\",'
        r'\"cat_id\":\"2\",\"sndlvl_id\":\"null\",\"data_type\":\"vod\"}',
        '{"user_id":"U2","play_start_time":"2024-13-02 10:00:05","loose"}',
    )
    first, second = app_lines.parse_app_vod(raw).orderBy("uuid").collect()
    assert (first.uuid, first.play_start_time, first.media_name) == ("U1", "20240102100005", "a")
    assert (first.category_id, first.media_id, first.play_end_time) == ("2", "", "")
    assert (second.uuid, second.play_start_time) == ("U2", "")


def test_record_widths(spark):
    rows = records.record_widths(lines(spark, "0x11|a||", "0x11|a|b", "0x03|a", "0x11|c||"), "0x11")
    assert sorted(r.width for r in rows.collect()) == [3, 4]


def test_two_columns(spark):
    got = files.read_two_columns(lines(spark, "20180101\t 5", " 7   20180102 "), "a", "b").orderBy("a")
    assert [tuple(r) for r in got.collect()] == [("20180101", "5"), ("7", "20180102")]
    assert got.select(F.col("a")).count() == 2
