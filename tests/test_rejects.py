"""Bad responses go to the rejects table with their reason; the good ones load."""

import json
import os

import pytest

from hourmart.sources import rejects as R
from hourmart.streaming.refresh import load_generation_files, load_price_files, load_weather_files, start_refresh


def _doc(city="Sofia", times=("2024-01-01T00:00", "2024-01-01T01:00"), **hourly):
    return {"city": city, "hourly": {"time": list(times), "temperature_2m": [1.0] * len(times), **hourly}}


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


GOOD = [json.dumps(_doc()), json.dumps(_doc("Варна", shortwave_radiation=[None])), json.dumps(_doc(times=())),
        json.dumps({**_doc(times=["2024-01-01T05:00:30"]), "elevation": {"m": 1}})]
BAD = [('{"city": "Sofia", "hourly": {"time": ["2024', "not_json"), ("{} {}", "not_json"), ("null", "not_object"),
       ("[%s]" % json.dumps(_doc()), "not_object"), ('"text"', "not_object"),
       (json.dumps(_doc(temperature_2m=["warm", 2.0])), "wrong_type"), (json.dumps({"city": "S", "hourly": 3}), "wrong_type"),
       (json.dumps(_doc(city=None)), "no_city"), ("{}", "no_city"), (json.dumps({"city": "S", "error": True}), "no_hours"),
       (json.dumps(_doc(times=["2024-01-01T00:00", None])), "bad_time"),
       (json.dumps(_doc(times=["2024-02-30T00:00"])), "bad_time"), (json.dumps(_doc(times=["soon"])), "bad_time"),
       (json.dumps(_doc(shortwave_radiation=[1.0, 2.0, 3.0])), "value_without_time")]


def test_each_reason(spark):
    texts = spark.createDataFrame([(t,) for t in GOOD] + [(t,) for t, _ in BAD], "value string")
    got = {r.response: r.reason for r in R.judged(texts, "weather").collect()}
    assert got == dict([(t, None) for t in GOOD] + BAD)


def test_files_fall_into_responses(spark):
    pretty = json.dumps(_doc(), indent=2)
    files = [pretty, "\n".join(GOOD[:2]) + "\n\n" + BAD[0][0], pretty[:-30], "", "\n \n"]
    rows = R.judged(R.responses(spark.createDataFrame([(t,) for t in files], "value string")), "weather").collect()
    assert sorted((r.response, r.reason) for r in rows if r.reason) == sorted(
        [(t, "not_json") for t in (BAD[0][0], pretty[:-30], "", "\n \n")])
    assert sorted(r.response for r in rows if not r.reason) == sorted([pretty, *GOOD[:2]])


@pytest.mark.parametrize("feed, good, bad", [
    ("prices", [{"timestamp_utc": "2024-01-01T00:00:00Z", "price": 1.0}, {"timestamp_utc": "2024-01-01T02:00:00+0100"}],
     [({"price": 2.0}, "no_time"), ({"timestamp_utc": "noon"}, "bad_time"),
      ({"timestamp_utc": "2024-01-01T00:00:00Z", "price": "low"}, "wrong_type")]),
    ("generation", [{"timestamp_utc": "2024-01-01T00:00:00Z", "source": "Solar", "mw": 1.0}],
     [({"timestamp_utc": "2024-01-01T00:00:00Z", "mw": 1.0}, "no_source"), ({"source": "Solar"}, "no_time"),
      ({"timestamp_utc": "2024-01-01T00:00:00Z", "source": "Solar", "mw": "much"}, "wrong_type")])])
def test_market_feeds(spark, scratch, feed, good, bad):
    _write(f"{scratch}/in", "a.json", "\n".join(json.dumps(d) for d in good + [d for d, _ in bad]))
    load = load_price_files if feed == "prices" else load_generation_files
    with pytest.raises(Exception):
        load(spark, f"{scratch}/in", f"{scratch}/strict")
    assert load(spark, f"{scratch}/in", f"{scratch}/out", rejects=f"{scratch}/rej") == \
        len({d["timestamp_utc"] for d in good})
    kept = [(json.loads(r.response), r.reason) for r in R.read_rejects(spark, f"{scratch}/rej").collect()]
    assert sorted(kept, key=repr) == sorted(bad, key=repr)


def test_stream_goes_on_and_repeats_add_nothing(spark, scratch):
    land, table, rej = f"{scratch}/in", f"{scratch}/raw", f"{scratch}/rej"

    def stream(state):
        start_refresh(spark, "weather", land, table, f"{scratch}/{state}", rejects=rej).awaitTermination()
        return spark.read.parquet(table).count(), R.read_rejects(spark, rej).count()

    _write(land, "a.json", "\n".join([GOOD[0], BAD[0][0], BAD[0][0]]))
    assert stream("one") == (2, 2)  # equal responses of a file are two rejects
    _write(land, "b.json", BAD[-1][0])  # a batch of bad responses only
    _write(land, "c.json", json.dumps(_doc("Ruse"), indent=1))
    assert stream("one") == (4, 3)
    assert stream("two") == (4, 3)  # all files once more, as after a lost stream state
    load_weather_files(spark, land, table, rejects=rej)
    assert (spark.read.parquet(table).count(), R.read_rejects(spark, rej).count()) == (4, 3)


def test_only_bad_responses(spark, scratch):
    _write(f"{scratch}/in", "a.json", "\n".join(t for t, _ in BAD))
    assert load_weather_files(spark, f"{scratch}/in", f"{scratch}/raw", multi_line=False, rejects=f"{scratch}/rej") == 0
    assert R.read_rejects(spark, f"{scratch}/rej").count() == len(BAD)
    assert R.read_rejects(spark, f"{scratch}/none").count() == 0


def test_a_load_judges_each_response_once(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F

    from hourmart.streaming import refresh

    _write(f"{scratch}/in", "a.json", "\n".join([*GOOD, BAD[0][0]]))
    seen, read = spark.sparkContext.accumulator(0), refresh.read_judged

    def passed(reason):
        seen.add(1)
        return reason

    count = F.udf(passed, "string").asNondeterministic()
    monkeypatch.setattr(refresh, "read_judged", lambda *a: read(*a).withColumn("reason", count("reason")))
    load_weather_files(spark, f"{scratch}/in", f"{scratch}/out", multi_line=False, rejects=f"{scratch}/rej")
    assert seen.value == len(GOOD) + 1
    assert [r.reason for r in R.read_rejects(spark, f"{scratch}/rej").collect()] == ["not_json"]
