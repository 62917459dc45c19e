"""Streams, leases, rate caps and crawls on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill import sources
from lexmill.operators import crawl, pacing, vectors
from lexmill.streaming import VectorStore, leases, start_worker, windows


def brute_leases(rows, length, end=None):
    """The log of each row by plain rules: who holds it until when."""
    out = []
    for key in {r[0] for r in rows}:
        holder, until, done = None, 0, False
        for _, at, request, worker, kind in sorted(r for r in rows if r[0] == key):
            if holder and at >= until:
                out.append((key, until, None, holder, None, "expired"))
                holder = None
            if done:
                told = "over"
            elif kind == "claim":
                told = "busy" if holder else "granted"
                if not holder:
                    holder, until = worker, at + length
            elif holder != worker:
                told = "lost"
            elif kind == "beat":
                told, until = "kept", at + length
            else:
                told, holder, done = ("marked", None, True) if kind == "done" else ("freed", None, False)
            out.append((key, at, request, worker, kind, told))
        if holder and end is not None and end >= until:
            out.append((key, until, None, holder, None, "expired"))
    return sorted(map(str, out))


def test_lease_log_against_plain_rules(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(5), rng.randrange(1, 300), i, f"w{rng.randrange(3)}", rng.choice(["claim"] * 6 + ["beat", "beat", "fail", "done"])) for i in range(500)]
    rows += [(9, i, 1000 + i, "w0", "claim") for i in range(1, 200)]
    df = spark.createDataFrame(rows + rows[:40], leases.REQUEST)  # some are delivered twice
    for length, end in ((7, None), (7, 400), (50, 250)):
        assert sorted(str(tuple(r)) for r in leases.lease_log(df, length, end).collect()) == brute_leases(rows, length, end)
    assert leases.lease_log(df.limit(0), 5, 9).count() == 0


def test_a_killed_worker_loses_its_rows_and_each_is_done_once(spark, tmp_path):
    """Worker a claims ten rows, marks three and is gone; its leases run out, b gets and marks the others; a's late marks are lost.
    The stream itself is stopped after each step and goes on from its checkpoint; one file comes twice."""
    second = 1_000_000
    steps = [
        [(i, 10 * second, i, "a", "claim") for i in range(10)] + [(i, 11 * second, 100 + i, "b", "claim") for i in range(10)],
        [(i, 12 * second, 200 + i, "a", "done") for i in range(3)],
        [(99, 60 * second, 300, "b", "claim")],  # time passes: nothing is asked of rows 3 to 9
        [(i, 61 * second, 400 + i, "b", "claim") for i in range(10)],
        [(i, 62 * second, 500 + i, "a", "done") for i in range(3, 10)] + [(i, 63 * second, 600 + i, "b", "done") for i in range(10)],
        [(99, 200 * second, 700, "b", "beat")],
        [(99, 201 * second, 800, "b", "claim")],
    ]
    told = []
    for k, rows in enumerate(steps):
        for _ in range(2 if k == 4 else 1):
            spark.createDataFrame(rows, leases.REQUEST).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = leases.leased(spark.readStream.schema(leases.REQUEST).parquet(f"{tmp_path}/in"), 20 * second)
        write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
        stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()
        told.append(sorted((r.id, r.worker, r.outcome) for r in spark.read.parquet(f"{tmp_path}/out").collect()))
    expired = [(i, "a", "expired") for i in range(3, 10)]
    assert not set(expired) & set(told[1]) and set(expired) <= set(told[2])  # by the timer, before anyone asks
    out = spark.read.parquet(f"{tmp_path}/out")
    marks = out.where("outcome = 'marked'").select("id", "worker").collect()
    assert sorted(map(tuple, marks)) == [(i, "a" if i < 3 else "b") for i in range(10)]
    assert {r.id for r in out.where("outcome = 'lost' AND worker = 'a'").collect()} == set(range(3, 10))
    assert {tuple(r) for r in leases.statuses(out).where("id < 10").collect()} == {(i, "done", "a" if i < 3 else "b") for i in range(10)}


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    schema = "k string, ts timestamp, n int"
    at = lambda s: F.timestamp_seconds(F.lit(1_700_000_000 + s)).alias("ts")
    put = lambda *times: [spark.range(1).select(F.lit("a").alias("k"), at(s), F.lit(1).alias("n")).write.mode("append").parquet(f"{tmp_path}/in") for s in times]
    found, total = set(), 0
    for times in ((0, 10, 100), (95, 40, 20, 300)):  # the watermark is 70 then: 40 and 20 come too late for their windows
        put(*times)
        stream = windows.tumbling(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "ts", "20 seconds", ["k"], {"n": F.sum("n")}, late="30 seconds")
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        query.awaitTermination()
        total += windows.dropped(query)
        found = {(int(r.start.timestamp()) - 1_700_000_000, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert total == 2 and found == {(0, 2), (80, 1), (100, 1)}


def test_schedule_against_one_after_the_other(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["hot"] * 20 + ["b", "c", None]), rng.randrange(0, 4000) if i % 50 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, host string, at long")
    for gap, burst in ((1, 1), (3, 1), (2, 5)):
        got = {r.id: (r.place, r.start) for r in pacing.schedule(df, "host", "at", "id", gap, burst).collect()}
        want = {i: (None, None) for i, _, at in rows if at is None}
        for host in ("hot", "b", "c", None):
            slot = None
            for k, (at, i) in enumerate(sorted((at, i) for i, h, at in rows if h == host and at is not None)):
                slot = at if slot is None else max(at, slot + gap)
                want[i] = (k, max(at, slot - (burst - 1) * gap))
        assert got == want
    assert pacing.schedule(df.limit(0), "host", "at", "id", 1).count() == 0


def test_crawl_with_cycles_repeats_and_runs(spark, tmp_path):
    links = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "a"), ("c", "c"), ("c", "d"), ("x", "y"), ("d", None), ("b", "e")]
    df = spark.createDataFrame(links, "source string, target string")
    seeds = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    told = lambda found: dict(map(tuple, found.collect()))
    seen = crawl.Seen(spark, f"{tmp_path}/seen")
    assert told(crawl.crawl(df, seeds, seen)) == {"a": 0, "b": 1, "c": 2, "e": 2, "d": 3}
    more = df.unionByName(spark.createDataFrame([("b", "f"), ("f", "g"), ("g", "a")], df.schema))
    assert told(crawl.crawl(more, seeds, seen, run=1)) == {"f": 1, "g": 2}
    assert told(crawl.crawl(more, spark.createDataFrame([("x",)], "url string"), seen, run=2)) == {"x": 0, "y": 1}
    assert told(crawl.crawl(more, seeds, seen, run=1)) == {"f": 1, "g": 2}  # a repeated run finds the same
    assert told(crawl.crawl(df, seeds, crawl.Seen(spark, f"{tmp_path}/other"), most_depth=1)) == {"a": 0, "b": 1}
    assert told(crawl.crawl(df, seeds.limit(0), crawl.Seen(spark, f"{tmp_path}/none"))) == {}


def test_a_new_checkpoint_leaves_what_an_old_one_wrote(spark, tmp_path):
    config = vectors.EmbedConfig(dim=4)
    rows = lambda ids: spark.createDataFrame([(i, "u", "t", "s", 1, f"text {i}", "pending", None, None, None) for i in ids], sources.QUEUE)
    for k, ids in enumerate((range(10), range(10, 15))):
        rows(ids).write.parquet(f"{tmp_path}/queue{k}")
        start_worker(spark, f"{tmp_path}/queue{k}", f"{tmp_path}/store", f"{tmp_path}/ck{k}", lambda: vectors.stub_backend(4), config).awaitTermination()
    store = VectorStore(spark, f"{tmp_path}/store")
    assert sorted(r.queue_id for r in store.read().collect()) == list(range(15)) and store.marks().count() == 15
    rows(range(20, 22)).write.parquet(f"{tmp_path}/queue2")
    start_worker(spark, f"{tmp_path}/queue2", f"{tmp_path}/elsewhere", f"{tmp_path}/ck2", lambda: vectors.stub_backend(4), config).awaitTermination()
    both = VectorStore(spark, f"{tmp_path}/store", f"{tmp_path}/elsewhere", f"{tmp_path}/none")
    assert both.read().count() == 17 and {r.status for r in both.marked(rows(range(22))).where("id >= 20").collect()} == {"done"}


def test_folding_follows_what_is_new_and_changes_nothing(spark, tmp_path):
    config = vectors.EmbedConfig(dim=4)
    store = VectorStore(spark, f"{tmp_path}/store")
    rows = lambda ids, text: spark.createDataFrame([(i, "u", "t", "s", 1 + len(text), f"{text} {i}", "pending", None, None, None) for i in ids], sources.QUEUE)
    told = lambda: (sorted((r.queue_id, r.chunk_no, tuple(r.vector), r.created_at) for r in store.read().collect()), sorted((r.id, r.status) for r in store.marked(rows(range(40), "")).collect()))
    for k in range(6):
        store.upsert(rows(range(5 * k, 5 * k + 8), "x" * k), k, lambda: vectors.stub_backend(4), config, "a")
    before = told()
    store.fold(most=3)
    assert told() == before and len(store.batches("vectors")) == len(store.batches("marks")) == 1
    first = store.batches("vectors")
    store.upsert(rows([2, 39], "new"), 6, lambda: vectors.stub_backend(4), config, "a")
    changed = told()
    assert changed != before and changed[0][2][:2] == (2, 1)  # the first chunk number stays
    store.fold(most=3)
    assert told() == changed and set(first) < set(store.batches("vectors"))  # what was folded before is not read again
    store.upsert(rows([3], "newer"), 6, lambda: vectors.stub_backend(4), config, "a")  # a replay of a batch that was folded
    store.upsert(rows([3], "newer"), 6, lambda: vectors.stub_backend(4), config, "a")
    last = told()
    store.fold(most=3)
    store.fold(most=3)
    assert told() == last and len(store.batches("vectors")) == 1 and first[0] not in store.batches("vectors")


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
