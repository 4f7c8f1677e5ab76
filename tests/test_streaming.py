import os
import tempfile

from dealcast.operators.rollup import daily_rollup, parse_posts
from dealcast.sources.posts import POSTS_SCHEMA
from dealcast.streaming.rollup import compact_rollup, read_rollup_state, stream_daily_rollup


def test_stream_rollup_merges_batches_and_late_posts(spark):
    root = tempfile.mkdtemp(prefix="dealcast-stream-")
    src = os.path.join(root, "src")
    first = [("a", "s", "20% Off", "2020-06-01", 1, 1, 1), ("a", "s", "Free Gift", "2020-06-01", 2, 2, 2),
             ("a", "s", "10% Off", "2020-06-20", 3, 3, 3)]
    # second file: one more post for 06-20 and one that arrives very late (05-01)
    second = [("a", "s", "30% Off", "2020-06-20", 4, None, 4), ("a", "s", "50% Off", "2020-05-01", 5, 5, 5)]
    spark.createDataFrame(first, POSTS_SCHEMA).coalesce(1).write.parquet(os.path.join(src, "f1"))
    spark.createDataFrame(second, POSTS_SCHEMA).coalesce(1).write.parquet(os.path.join(src, "f2"))
    out, ck = os.path.join(root, "out"), os.path.join(root, "ck")
    q = stream_daily_rollup(spark, os.path.join(src, "*"), out, ck, max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 2
    got = {r.posted_date.isoformat(): r for r in read_rollup_state(spark, out).collect()}
    batch = daily_rollup(parse_posts(spark.createDataFrame(first + second, POSTS_SCHEMA)), distinct_counts=False)
    want = {r.posted_date.isoformat(): r for r in batch.collect()}
    assert got == want and got["2020-06-20"].n_posts == 2 and got["2020-05-01"].discount_off == 0.5
    compacted = {r.posted_date.isoformat(): r for r in compact_rollup(spark, out, os.path.join(root, "c")).collect()}
    assert compacted == want


def test_streaming_query_takes_a_file_for_every_core_a_batch(spark, monkeypatch):
    from dealcast.registry import io_queries
    rows = [("a", "s", f"{i % 9}0% Off", f"2020-06-{i % 20 + 1:02d}", i, 1, 2) for i in range(400)]
    df = spark.createDataFrame(rows, POSTS_SCHEMA)
    seen, real = [], io_queries.stream_daily_rollup

    def started(*args, **kw):
        seen.append((kw["max_files_per_trigger"], len(spark.read.parquet(args[1]).inputFiles()), q := real(*args, **kw)))
        return q

    monkeypatch.setattr(io_queries, "posts", lambda *_: df)
    monkeypatch.setattr(io_queries, "stream_daily_rollup", started)
    got = {(r.posted_date, r.n_posts, r.discount_off) for r in io_queries.q_stream(spark, "").collect()}
    want = {(r.posted_date, r.n_posts, r.discount_off) for r in daily_rollup(parse_posts(df), distinct_counts=False).collect()}
    cores = spark.sparkContext.defaultParallelism
    (per_batch, files, query), = seen
    assert got == want and (per_batch, files) == (cores, 4 * cores)
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 4
