from pairloom import streaming


def test_compaction_equals_batch(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    source = str(tmp_path / "in")
    events.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    q = streaming.compact_log(stream, ["user_id", "event_type"], ["ts", "event_id"], str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = streaming.compacted(spark, str(tmp_path / "out"))
    assert sum(p.name.startswith("v") for p in (tmp_path / "out").iterdir()) <= 2
    want = streaming.latest(events, ["user_id", "event_type"], ["ts", "event_id"])
    columns = ["user_id", "event_type", "event_id"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_days_close_behind_the_watermark(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    source, late = str(tmp_path / "in"), "2 days"
    for n, part in enumerate(("value < 50", "not coalesce(value < 50, false)")):
        events.where(part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    q = streaming.day_counts(stream, "ts", late).writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("path", str(tmp_path / "days")).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(120)
    assert q.exception() is None
    closed = {str(r.day)[:10]: r.n for r in spark.read.schema("day timestamp, n long").parquet(str(tmp_path / "days")).collect()}
    want = {str(r.d): r["count"] for r in events.selectExpr("cast(ts as date) as d").groupBy("d").count().collect()}
    last = max(want)
    assert all(want[d] == n for d, n in closed.items()) and set(want) - set(closed) <= set(sorted(want)[-4:]) and last not in closed
    months = streaming.month_counts(spark.createDataFrame([(d, n) for d, n in want.items()], "day string, n long").withColumn("day", streaming.F.to_timestamp("day")))
    quarters = {}
    for d, n in want.items():
        key = f"{d[:4]}-{(int(d[5:7]) - 1) // 3 * 3 + 1:02d}-01"
        quarters[key] = quarters.get(key, 0) + n
    assert {str(r.window_start)[:10]: r.n for r in months.collect()} == quarters
