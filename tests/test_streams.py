import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lodestone.streaming import flush, streams, watch


def rows(spark, items):
    return spark.createDataFrame(items, "k string, s double, x string").select("k", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("t"), "x")


def test_batches_by_size_or_gap_end_with_the_stream(spark, tmp_path):
    first = [("a", float(i), f"a{i}") for i in range(5)] + [("b", 1.0, "b0")]
    later = [("a", 5.5, "a5"), ("b", 100.0, "b1"), ("c", 300.0, "c0"), ("c", 301.0, "c1")]
    for n, part in enumerate((first, later)):
        rows(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.01)
    stream = streams.table_stream(spark, str(tmp_path / "in"), 1)
    out = streams.run_to_end(streams.size_or_gap_batches(stream, "k", "x", "t", 2, 30_000), str(tmp_path / "out"), str(tmp_path / "state")).collect()
    got = sorted((r.key, tuple(r.items)) for r in out)
    rest = sorted((r.key, tuple(r.items)) for r in streams.held_back(spark, str(tmp_path / "state")).collect())
    assert {x for _, b in got + rest for x in b} == {x[2] for x in first + later}
    assert ("a", ("a0", "a1")) in got and ("b", ("b0",)) in got and ("c", ("c0", "c1")) in got
    assert all(len(b) <= 2 for _, b in got)


def test_session_batches(spark):
    got = streams.session_batches(rows(spark, [("a", 0.0, ""), ("a", 29.0, ""), ("a", 60.0, "")]), "t", "k").orderBy("start").collect()
    assert [r.n for r in got] == [2, 1]


def test_changes(spark, tmp_path):
    listing = spark.createDataFrame([(1, "p", 5), (2, "p", 5), (3, "p", 9), (4, "p", 7), (5, "q", 1)], "seen int, path string, mtime int")
    assert sorted((r.seen, r.kind) for r in streams.modified(listing, "path", "mtime", "seen").collect()) == [(1, "created"), (3, "modified"), (5, "created")]
    table = spark.createDataFrame([("p", "1"), ("p", "1"), ("p", "2"), ("q", "1")], "k string, d string").coalesce(1)
    table.write.parquet(str(tmp_path / "in"))
    got = streams.run_to_end(streams.changed_stream(streams.table_stream(spark, str(tmp_path / "in")), "k", "d"), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted((r.key, r.digest) for r in got.collect()) == [("p", "1"), ("p", "2"), ("q", "1")]


def test_first_seen_within_a_watermark(spark, tmp_path):
    rows(spark, [("a", 1.0, "x"), ("a", 2.0, "y"), ("b", 1.0, "z")]).write.parquet(str(tmp_path / "in"))
    s = streams.first_seen(streams.table_stream(spark, str(tmp_path / "in")), ["k"], "t")
    assert streams.run_to_end(s, str(tmp_path / "out"), str(tmp_path / "state")).count() == 2


def _until(check, seconds=40):
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        if check():
            return True
        time.sleep(0.2)
    return False


def test_watching_skips_what_is_there_and_tells_changes_over_a_restart(spark, tmp_path):
    folder, seen = tmp_path / "code", []
    folder.mkdir()
    (folder / "old.vex").write_text("@P = 1;")
    (folder / "other.bin").write_text("no")

    def run(until):
        stream = watch.watch(spark, str(folder), str(tmp_path / "log"), files=1)
        take = lambda b, _: seen.extend((os.path.basename(r.path), r.kind, r.text) for r in b.collect())
        query = stream.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="300 milliseconds").start()
        try:
            assert _until(until)
        finally:
            query.stop()

    def first():
        if not (folder / "new.vex").exists():
            (folder / "new.vex").write_text("@P = 2;")
            (folder / "deep").mkdir()
            (folder / "deep" / "more.md").write_text("# é")
        return len(seen) == 2

    run(first)
    (folder / "old.vex").write_text("@P = 33;")  # while nothing runs
    run(lambda: len(seen) == 3)
    (folder / "last.h").write_text("int")
    run(lambda: len(seen) == 4)
    assert sorted(seen[:2]) == [("more.md", "created", "# é"), ("new.vex", "created", "@P = 2;")]
    assert seen[2:] == [("old.vex", "modified", "@P = 33;"), ("last.h", "created", "int")]


def test_listings_are_kept_and_folded(tmp_path):
    folder = tmp_path / "code"
    folder.mkdir()
    (folder / "a.md").write_text("x")
    options = {"path": str(folder), "log": str(tmp_path / "log")}
    one = watch.Listing(options)
    one.begin(existing=True)
    assert one.look() == 1 and one.look() == 1
    for k in range(20):
        (folder / f"b{k}.md").write_text("y")
        assert one.look() == k + 2
    assert [os.path.basename(p) for p, *_ in one.between(0, 3)] == ["a.md", "b0.md", "b1.md"]
    two = watch.Listing(options)
    two.forget(18)
    names = sorted(two._names())
    assert names == ["19", "20", "21", "snapshot-18"]
    assert two.look() == 21 and len(two.known) == 21
    assert [os.path.basename(p) for p, *_ in two.between(18, 21)] == ["b17.md", "b18.md", "b19.md"]


def put(spark, folder, lo, hi):
    spark.range(lo, hi).withColumn("t", F.timestamp_micros(F.col("id") * 1_000_000 + 123_456)).withColumn("x", F.when(F.col("id") % 2 == 0, F.lit("a"))).coalesce(1).write.mode("append").parquet(str(folder))


def passed_on(spark, folder):
    """ids by shard and flush, each row as it came in."""
    out = {}
    schema = spark.range(1).select("id", F.timestamp_micros("id").alias("t"), F.lit("a").alias("x")).schema
    for r in flush.flushed(spark, str(folder), schema).orderBy("shard", "flush", "id").collect():
        assert r.x == ("a" if r.id % 2 == 0 else None) and r.t.microsecond == 123456
        out.setdefault((r.shard, r.flush), []).append(r.id)
    return out


def test_flushes_by_size_and_two_runs_with_a_drain_each(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 7)
    put(spark, tmp_path / "in", 7, 12)
    policy, where = flush.FlushPolicy(5, 1e6), (str(tmp_path / "f"), str(tmp_path / "c"))
    stream = lambda: streams.table_stream(spark, str(tmp_path / "in"), 1)
    flush.flushing(stream(), policy, *where, once=True, shards=1, order="id").awaitTermination()
    assert passed_on(spark, tmp_path / "f") == {(0, 0): [0, 1, 2, 3, 4], (0, 1): [5, 6, 7, 8, 9]}
    flush.drain(stream(), policy, *where, shards=1, order="id")
    put(spark, tmp_path / "in", 12, 14)
    flush.drain(stream(), policy, *where, shards=1, order="id")
    flush.drain(stream(), policy, *where, shards=1, order="id")  # nothing is held
    assert passed_on(spark, tmp_path / "f") == {(0, 0): [0, 1, 2, 3, 4], (0, 1): [5, 6, 7, 8, 9], (0, 2): [10, 11], (0, 3): [12, 13]}


def test_a_batch_whose_commit_is_lost_passes_its_rows_on_once(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 8)
    policy, where = flush.FlushPolicy(3, 1e6), (str(tmp_path / "f"), str(tmp_path / "c"))
    stream = lambda: streams.table_stream(spark, str(tmp_path / "in"), 1)
    flush.flushing(stream(), policy, *where, once=True, shards=2).awaitTermination()
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"))
    for lost in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        lost.unlink(missing_ok=True)  # as if the process had ended after the output
    put(spark, tmp_path / "in", 8, 11)
    flush.drain(stream(), policy, *where, shards=2)
    got = passed_on(spark, tmp_path / "f")
    assert sorted(i for ids in got.values() for i in ids) == list(range(11))
    assert {k for k in got} == {(s, n) for s in (0, 1) for n in range(1 + max(n for t, n in got if t == s))}


def test_a_consumer_that_fails_after_its_output_is_given_the_same_flushes_again(spark, tmp_path):
    put(spark, tmp_path / "in", 0, 9)
    seen = []

    def consume(df, number):
        seen.append((number, sorted((r.flush, r.id) for r in df.collect())))
        if len(seen) == 1:
            raise RuntimeError("the process ends here")

    policy, where = flush.FlushPolicy(4, 1e6), (str(tmp_path / "f"), str(tmp_path / "c"))
    stream = lambda: streams.table_stream(spark, str(tmp_path / "in"), 1)
    with pytest.raises(Exception, match="ends here"):
        flush.flushing(stream(), policy, *where, once=True, shards=1, order="id", consume=consume).awaitTermination()
    flush.flushing(stream(), policy, *where, once=True, shards=1, order="id", consume=consume).awaitTermination()
    assert seen[0] == seen[1] == (0, [(k // 4, k) for k in range(8)])


@pytest.mark.parametrize("since", ["flush", "add"])
def test_flushes_by_time(spark, tmp_path, since):
    put(spark, tmp_path / "in", 0, 3)
    stream = streams.table_stream(spark, str(tmp_path / "in"), 1)
    query = flush.flushing(stream, flush.FlushPolicy(50, 3.0, since), str(tmp_path / "f"), str(tmp_path / "c"), every="500 milliseconds", shards=1)
    try:
        there = lambda: (tmp_path / "f" / "out" / "_spark_metadata").exists() and sum(map(len, passed_on(spark, tmp_path / "f").values()))
        assert _until(lambda: there() == 3)
        put(spark, tmp_path / "in", 3, 5)
        assert _until(lambda: there() == 5)
    finally:
        query.stop()
    assert sorted(passed_on(spark, tmp_path / "f").values()) == [[0, 1, 2], [3, 4]]


def test_deadlines():
    assert flush.EXPORT.deadline(1000, 9000) == 61_000 and flush.DAEMON.deadline(1000, 9000) == 6000 and flush.WATCHER.deadline(1000, 9000) == 39_000


def test_two_tiers(spark):
    one = lambda d: d.withColumn("score", F.col("id") / 10)
    two = lambda d: d.withColumn("prompt", F.lit("p"))
    rows_ = watch.two_tiers(one, F.col("score") < 0.3, two)(spark.range(6)).collect()
    assert {(r.id, r.stage, r.prompt) for r in rows_} == {(i, "validation", None) if i < 3 else (i, "complete", "p") for i in range(6)}
    assert {r.stage for r in watch.two_tiers(one, F.lit(False))(spark.range(2)).collect()} == {"complete"}


def test_callbacks_and_metrics(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "in"))
    said = []
    listener = watch.Callbacks(lambda n, total: said.append(("progress", total)), lambda e: said.append(("error", e)), lambda n: said.append(("complete", n)))
    spark.streams.addListener(listener)
    try:
        streams.run_to_end(streams.table_stream(spark, str(tmp_path / "in"), 10), str(tmp_path / "out"), str(tmp_path / "state"))
        assert _until(lambda: ("complete", 7) in said)
    finally:
        spark.streams.removeListener(listener)
    assert ("progress", 7) in said and not any(k == "error" for k, _ in said)
    got = []
    watch.observed(spark.range(5), "n", got.append).collect()
    assert _until(lambda: got == [{"rows": 5}])


def test_fresh_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(json.dumps({"a": 1}))
    stream = spark.readStream.option("wholetext", True).text(str(tmp_path / "in")).select("value", "_metadata")
    got = streams.run_to_end(watch.fresh_files(stream, F.lit("2000-01-01").cast("timestamp")).select("value"), str(tmp_path / "o1"), str(tmp_path / "s1"))
    none = streams.run_to_end(watch.fresh_files(stream, F.lit("2999-01-01").cast("timestamp")).select("value"), str(tmp_path / "o2"), str(tmp_path / "s2"))
    assert got.count() == 1 and none.count() == 0


def test_files_and_samples_are_told(spark):
    files, samples, taken = [], [], []
    run = watch.telling(lambda b, n: taken.append((n, b.count())), on_file=lambda p, n: files.append((p, n)), on_sample=samples.append)
    run(spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "path string, x int"), 7)
    assert taken == [(7, 3)] and sorted(files) == [("a", 2), ("b", 1)] and sorted(s["x"] for s in samples) == [1, 2, 3]


def test_a_file_is_streamed_once_and_whole(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one\ntwo")
    for _ in range(2):
        got = streams.run_to_end(streams.file_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
        assert [(os.path.basename(r.path), r.text) for r in got.collect()] == [("a.txt", "one\ntwo")]
