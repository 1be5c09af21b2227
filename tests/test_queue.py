from quire.streaming.queue import SERVICES, claims


def test_each_ready_service_is_claimed_once(spark, tmp_path):
    source, claimed, checkpoint = (str(tmp_path / x) for x in ("source", "claimed", "checkpoint"))
    rows = [("a", "Paid", 1, "x-MANUSCRIPT"), ("b", "Paid", 0, "x-MANUSCRIPT"), ("c", "Void", 1, "x-MANUSCRIPT"), ("a", "Paid", 1, "x-MANUSCRIPT"), ("d", "Paid", 1, "x-COVER")]
    seen = []
    for batch in (rows, [*rows, ("e", "Paid", 1, "y-MANUSCRIPT")]):
        spark.createDataFrame(batch, SERVICES).coalesce(1).write.mode("append").parquet(source)
        claims(spark, source, claimed, checkpoint, lambda new, number: seen.append(sorted(r.id for r in new.collect()))).awaitTermination()
    assert seen == [["a"], ["e"]]
    assert sorted(r.id for r in spark.read.parquet(claimed).collect()) == ["a", "e"]
