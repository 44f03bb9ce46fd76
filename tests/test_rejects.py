"""Bad records are counted by type and reason, and day folders stay few."""

import json
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tvtrail.functions.times import shift_day
from tvtrail.operators import hotkeys
from tvtrail.plans import app_day, mobile_day, reports_day, telecom_day
from tvtrail.sources import app_lines, files, records, rejects
from tvtrail.schemas import ERROR, INIT, PAGE_VIEW

DAY = "20240102"
TIME, TIME_MS = "2024-01-02T10:00:00+0000", "2024-01-02T10:00:00.000+0000"


def power_on(time=TIME, fields=24, user="U1"):
    f = ["0x01", "mk", "mac", "md", "A.1", "4", "x", "10.0.0.1", "acc", user, "u", "android", time, "HNYD", "0731"]
    return "|".join((f + [""] * 20)[:fields])


def record(code, time=TIME, width=11, user="U1"):
    return "|".join(([code, "MAC", user, "003", time] + ["x"] * 40)[:width])


LINES = [
    power_on(), power_on(fields=14), power_on(fields=13, time=""), power_on(time="2024-13-02T10:00:00+0000"),
    record("0x11"), record("0x11", "soon"), record("0x11", "") + r"\x0A" + record("0x09", None or "x") + r"\x0A" + record("0x10"),
    "2024-01-01 06:50:19 - 10.0.0.1 - 0x07" + record("0x07", "no")[4:], record("0x99", "no"), record("0x99"), "", "noise", "a|b|c|d|" + TIME,
]
EXPECTED = {("0x01", "short"): 2, ("0x01", "no time"): 1, ("0x11", "no time"): 2, ("0x09", "no time"): 1, ("0x07", "no time"): 1,
            ("other", "no time"): 3}


def frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def counts(report):
    return {(r["type"], r["reason"]): r["n"] for r in report.collect()}


def test_records(spark):
    parsed = records.parse_mobile(frame(spark, LINES), rejects=True)
    found = counts(rejects.report(rejects.record_rejects(parsed), rejects.RECORD_REASONS))
    assert {k: n for k, n in found.items() if n} == EXPECTED
    assert set(found) == set(rejects.RECORD_REASONS)
    # The good rows are what the parser gives without rejects.
    good, plain = parsed.where("reject IS NULL"), records.parse_mobile(frame(spark, LINES))
    assert sorted(map(str, good.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    bad = parsed.where("reject IS NOT NULL").select("state", "user_id", "ts", "media_id").distinct().collect()
    assert {(r["state"], r["user_id"], r["media_id"]) for r in bad} == {(rejects.REJECT, "", "")}
    assert counts(rejects.report(rejects.record_rejects(records.parse_mobile(frame(spark, []), rejects=True)), rejects.RECORD_REASONS)) == {
        k: 0 for k in rejects.RECORD_REASONS}


@pytest.mark.parametrize("parse", [records.parse_favourites, records.power_on_records, records.positional_pages])
def test_other_parsers(spark, parse):
    args = (DAY, "HNYD") if parse is records.power_on_records else ()
    parsed = parse(frame(spark, LINES), *args, rejects=True)
    assert {k: n for k, n in counts(rejects.report(rejects.record_rejects(parsed), rejects.RECORD_REASONS)).items() if n} == EXPECTED
    plain = parse(frame(spark, LINES), *args)
    assert sorted(map(str, parsed.where("reject IS NULL").select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_app_lines(spark):
    online = ["not json", "{}", '{"uuid":" "}', '{"uuid":"a","apk_version":"1"}', '{"uuid":"a"}', "", '["x"]', '{"uuid":{"b":1}}', "null"]
    parsed = app_lines.parse_online(frame(spark, online), rejects=True)
    plain = app_lines.parse_online(frame(spark, online))
    assert sorted(map(str, parsed.where("reject IS NULL").drop("reject").collect())) == sorted(map(str, plain.collect()))
    found = counts(rejects.report(rejects.line_rejects(parsed, "online"), rejects.ONLINE_REASONS))
    assert sum(found.values()) + plain.count() == len(online) and found[("online", "no json")] >= 1
    vod = ['{"data_type":"vod","play_start_time":"2024-01-02 10:00:00","play_end_time":"2024-01-02 10:10:00"}',
           '{"data_type":"vod","play_start_time":"2024-01-02 10:00:00"}', '{"data_type":"live"}', "{}", "", "x:y"]
    parsed = app_lines.parse_app_vod(frame(spark, vod), rejects=True)
    assert counts(rejects.report(rejects.line_rejects(parsed, "vod"), rejects.APP_VOD_REASONS)) == {
        ("vod", "no pairs"): 3, ("vod", "no time"): 1}


def published(spark, warehouse, job):
    rows = spark.read.parquet(f"{warehouse}/bad_records").where(F.col("job") == job).collect()
    return {(r["type"], r["reason"]): r["n"] for r in rows}


def dictionaries(spark):
    def none(columns):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns.split()))

    return mobile_day.Dictionaries(
        channels=none("channel_name conf_channel_id conf_channel_name"),
        media=none("media_id media_name category_id category_name channel_id"), uploads=none("identityno c_cid pc_cid"),
        assets=none("thremdeiaid uuid midianame ydmedia ltmedia dxmedia cp"),
        test_users=spark.createDataFrame([("test",)], "key_word string"), review_words=none("category_name"))


def put(root, name, lines):
    os.makedirs(f"{root}/{name}")
    with open(f"{root}/{name}/part", "w") as out:
        out.write("\n".join(lines) + "\n")


def test_every_job_publishes_them(spark, tmp_path):
    logs, out = str(tmp_path / "logs"), str(tmp_path / "out")
    good = [record("0x11", user="U2"), record("0x11", user="test1"), power_on(user="U3")]
    put(logs, f"sdk_0x11/dt={DAY}", LINES + good)
    put(logs, f"sdk_0x01/dt={DAY}", [power_on(), power_on(fields=12)])
    put(logs, f"sdk_0x04/dt={DAY}", [record("0x04", "never"), record("0x04")])
    put(logs, f"sdk_0x07/dt={DAY}", [record("0x07", "never", 26), record("0x07", width=26)])
    previous = mobile_day.Job(spark, out, DAY, "HNYD", "sdk", True)
    args = (spark, logs, out, DAY, "HNYD", "all", dictionaries(spark), mobile_day.previous_pool(previous), "sdk", True)
    mobile_day.run(*args)
    everything = EXPECTED | {("0x01", "short"): 3, ("0x04", "no time"): 1, ("0x07", "no time"): 2}
    assert {k: n for k, n in published(spark, out, "mobile").items() if n} == everything
    assert {k: n for k, n in published(spark, out, "power-on").items() if n} == {("0x01", "short"): 1}
    assert {k: n for k, n in published(spark, out, "favourites").items() if n} == {("0x04", "no time"): 1}
    errors = files.read_partition(spark, f"{out}/mid_error_day").select("uuid").collect()
    assert sorted(r["uuid"] for r in errors) == ["U1", "U2"]
    users = files.read_partition(spark, f"{out}/user_info_pool").select("user_id").collect()
    assert "" not in {r["user_id"] for r in users}

    reports_day.in_out_paths(spark, logs, out, DAY, "HNYD", allow_missing=True)
    assert {k: n for k, n in published(spark, out, "in-out-paths").items() if n} == {("0x07", "no time"): 1}
    put(logs, f"telecom/sdk_0x01/dt={DAY}", [power_on(TIME_MS), power_on()])
    put(logs, f"telecom/sdk_0x07/dt={DAY}", [record("0x07", TIME_MS, 32), record("0x07", TIME, 32)])
    telecom_day.run(spark, f"{logs}/telecom", out, DAY, "HNDX", dictionaries(spark).test_users)
    assert {k: n for k, n in published(spark, out, "telecom").items() if n} == {("0x01", "no time"): 1, ("0x07", "no time"): 1}
    put(logs, f"itvrun_online/dt={DAY}", [json.dumps({"uuid": "a", "apk_version": "1"})] * 3 + ["x", "y", "{}"])
    app_day.online_users(spark, logs, out, DAY, "HNDX", dictionaries(spark).test_users)
    assert published(spark, out, "app-online") == {("online", "no json"): 2, ("online", "no box"): 1}

    # A day mended and run again: the counts of the earlier run go.
    with open(f"{logs}/itvrun_online/dt={DAY}/part", "w") as f:
        f.write('{"uuid":"a","apk_version":"1"}\n')
    app_day.online_users(spark, logs, out, DAY, "HNDX", dictionaries(spark).test_users)
    assert published(spark, out, "app-online") == {("online", "no json"): 0, ("online", "no box"): 0}
    assert len(published(spark, out, "mobile")) == len(rejects.RECORD_REASONS)


def test_stray_days_share_a_folder(spark, tmp_path, monkeypatch):
    """Boxes with wrong clocks: a thousand days, four folders, the same rows for the steps."""
    rng = random.Random(5)
    days = [shift_day(DAY, rng.randrange(-5000, 5000)) for _ in range(1000)] + [shift_day(DAY, d) for d in (-1, 0, 0, 1)]
    lines = [record("0x11", f"{d[:4]}-{d[4:6]}-{d[6:]}T{k % 24:02}:00:00+0000") for k, d in enumerate(days)] + [power_on(), "noise"]
    logs = str(tmp_path)
    put(logs, f"sdk_0x11/dt={DAY}", lines)
    job = mobile_day.Job(spark, str(tmp_path / "out"), DAY, "HNYD", "sdk", True)
    events = mobile_day.parsed_events(job, logs, dictionaries(spark).test_users)
    folder = re.sub("^file:/*", "/", events.inputFiles()[0]).split("/near=")[0]
    assert sorted(x for x in os.listdir(folder) if x.startswith("near=")) == [
        "near=after", "near=before", "near=elsewhere", "near=own"]
    good = mobile_day.good_events(events)
    assert good.count() == len(lines) - 1 and not hotkeys.find_hot_keys(good, "user_id", "ts")
    own = mobile_day.of_day(good)
    states = [r["state"] for r in own.select("state").collect()]
    assert sorted(states) == sorted([ERROR] * days.count(DAY) + [INIT])
    assert PAGE_VIEW not in states and re.search(r"PartitionFilters: \[.*near#\d+ = own", own._jdf.queryExecution().toString())
