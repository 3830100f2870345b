from collections import Counter

from metricloom.workload.documents import flat_json_events


def test_real_json_of_every_event_next_to_the_damaged_messages(spark, tmp_path):
    rows = [(i, f'{{"k": {10 + i}}}') for i in range(5)]
    spark.createDataFrame(rows, "event_id bigint, props string").write.parquet(str(tmp_path / "events.parquet"))
    out = Counter(tuple(r) for r in flat_json_events(spark, str(tmp_path)).collect())
    real = Counter((float(i), float(10 + i)) for i in range(5))
    broken, wrong_type, empty, missing, whole = (None, None), (1.0, None), (None, None), (None, None), (4.0, 14.0)
    assert out == real + Counter([broken, wrong_type, empty, missing, whole])
