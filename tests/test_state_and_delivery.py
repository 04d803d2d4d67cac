from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cernido.operators.delivery import kept_copies, new_messages, repeated_deliveries
from cernido.operators.incremental import TargetState, pending, publish_in_waves, replay_new_or_changed, run_incremental
from cernido.operators.snapshots import chain_diff, snapshot_diff
from cernido.streaming.messages import drain, read_stream

RUNS = "run_id string, user_id string, source_type string, source_scope_key string, snapshot_completed_at timestamp"
FILES = "file_id string, run_id string, source_uri string, checksum_sha256 string, revision_key string, updated_at timestamp, content string"
BOX = "delivery_no long, queue_name string, published_at timestamp, idempotency_key string, pubsub_message_id string"


def day(n):
    return None if n is None else dt.datetime(2024, 1, n)


@pytest.fixture
def chain(spark):
    runs = [("r1", "u", "d", "s", day(2)), ("r2", "u", "d", "s", None), ("r3", "u", "d", "s", day(4)), ("r3", "u", "d", "s", None),
            ("r4", "u", "d", "s", day(6)), ("x1", "v", "d", "s", day(1))]
    files = [
        ("a1", "r1", "A", "AA ", None, day(1), "clash"), ("b1", "r1", "B", "", "sha256:BB", day(1), ""), ("c1", "r1", "C", None, " ", day(1), ""),
        ("a2", "r2", "A", "zz", None, day(3), ""),
        ("a3", "r3", "A", None, "SHA256:aa", day(4), ""), ("b3", "r3", "B", "bx", None, day(4), ""), ("c3", "r3", "C", "cc", None, day(4), ""),
        ("a4", "r4", "A", "old", None, day(5), ""), ("a4", "r4", "A", "aa", None, day(6), ""), ("d4", "r4", "D", "dd", None, day(6), ""),
        ("a9", "x1", "A", "aa", None, day(1), ""), ("o", "unknown", "A", "aa", None, day(1), ""),
    ]
    return spark.createDataFrame(files, FILES), spark.createDataFrame(runs, RUNS)


def test_replay_finds_new_changed_and_unknown(chain):
    got = {r.file_id for r in replay_new_or_changed(*chain).collect()}
    assert got == {"a1", "b1", "c1", "b3", "c3", "d4", "a9"}


def test_chain_diff_against_the_run_before(chain):
    got = {(r.run_id, r.source_uri, r.change_kind) for r in chain_diff(*chain).collect()}
    assert got == {("r3", "B", "changed"), ("r3", "C", "changed"), ("r4", "B", "removed"), ("r4", "C", "removed"), ("r4", "D", "added")}


def test_empty_tables_give_nothing(spark):
    files, runs = spark.createDataFrame([], FILES), spark.createDataFrame([], RUNS)
    assert replay_new_or_changed(files, runs).count() == 0
    assert chain_diff(files, runs).count() == 0
    assert repeated_deliveries(spark.createDataFrame([], BOX)).count() == 0


def test_snapshot_diff_is_null_safe_and_reports_fields(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, None, 2), (None, "k", 3), (4, "s", 4), (4, "s", 4)], "id int, v string, n int")
    b = spark.createDataFrame([(1, "y", 1), (2, None, 2), (None, "k", 3), (5, "t", 5)], "id int, v string, n int")
    got = {r.id: (r.change_kind, r.changed_fields) for r in snapshot_diff(a, b, ["id"], ["v", "n"]).collect()}
    # an unknown value never equals another
    assert got == {1: ("changed", ["v"]), 2: ("changed", ["v"]), 4: ("removed", None), 5: ("added", None)}


def test_pending_compares_keys_null_safe(spark):
    source = spark.createDataFrame([(None, "1"), ("a", "1"), ("b", None), ("b", None)], "k string, ver string")
    state = spark.createDataFrame([(None, "1", 9), ("a", "0", 9), ("b", None, 9)], "k string, ver string, extra int")
    assert sorted(map(str, pending(source, state, ["k"], "ver").collect())) == sorted(map(str, source.filter("k is not null").collect()))


def test_incremental_run_survives_a_failure(spark, tmp_path):
    target = TargetState(spark, str(tmp_path / "target"))
    one = spark.createDataFrame([("a", "1"), ("b", "1")], "k string, ver string")
    assert run_incremental(one, target, ["k"], "ver").count() == 2
    two = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "1")], "k string, ver string")

    def fails(df):
        return df.withColumn("ver", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception):
        run_incremental(two, target, ["k"], "ver", fails)
    assert target.current() == 1 and target.read().count() == 2
    assert {r.k for r in run_incremental(two, target, ["k"], "ver").collect()} == {"a", "c"}
    assert {(r.k, r.ver) for r in target.read().collect()} == {("a", "2"), ("b", "1"), ("c", "1")}
    assert run_incremental(two, target, ["k"], "ver").count() == 0 and target.current() == 2
    with pytest.raises(RuntimeError):
        target.publish(two.filter("k = 'c'"), ["k"], 1)
    # the refused writer has changed nothing
    assert {(r.k, r.ver) for r in target.read().collect()} == {("a", "2"), ("b", "1"), ("c", "1")}


def test_only_changed_buckets_are_written_and_an_empty_target_reads(spark, tmp_path):
    target = TargetState(spark, str(tmp_path / "t"), buckets=16)
    many = spark.range(100).selectExpr("cast(id as string) as k", "'1' as ver")
    run_incremental(many, target, ["k"], "ver")
    first = target.manifest(1)["folders"]
    run_incremental(many.withColumn("ver", F.expr("if(k = '7', '2', ver)")), target, ["k"], "ver")
    second = target.manifest(2)["folders"]
    assert sum(first[b] != second[b] for b in first) == 1 and target.read().count() == 100
    assert target.read(1).filter("ver = '2'").count() == 0 and target.read().filter("ver = '2'").count() == 1
    empty = TargetState(spark, str(tmp_path / "e"))
    assert run_incremental(many.limit(0), empty, ["k"], "ver").count() == 0 and empty.read().count() == 0


def test_waves_publish_what_the_latest_runs_list(chain, spark, tmp_path):
    files, runs = chain
    got = publish_in_waves(files, runs, TargetState(spark, str(tmp_path / "w")))
    assert {(r.user_id, r.source_uri, r.content) for r in got.collect()} == {
        ("u", "A", "aa"), ("u", "B", "bx"), ("u", "C", "cc"), ("u", "D", "dd"), ("v", "A", "aa"),
    }
    assert publish_in_waves(files.limit(0), runs, TargetState(spark, str(tmp_path / "x"))).count() == 0


def test_copies_are_linked_directly_and_through_others(spark):
    rows = [
        (1, "q", day(5), "K1", "7"), (2, "q", day(3), " k1\t", None), (3, "q", None, None, "7"), (4, "p", day(1), None, "7"),
        (5, "q", day(2), "K2", "8"), (6, "q", day(2), "k2", "7"), (7, "q", None, "", " "), (8, "q", None, None, None), (9, "q", day(9), "", "55"),
    ]
    box = spark.createDataFrame(rows, BOX)
    assert {r.delivery_no for r in repeated_deliveries(box).collect()} == {1, 2, 3, 6}
    assert kept_copies(box).count() == 5
    fresh = spark.createDataFrame([(20, "q", day(1), None, "8"), (21, "q", day(1), "new", None), (22, "q", day(2), "NEW", "99")], BOX)
    assert {r.delivery_no for r in new_messages(fresh, box).collect()} == {21}


def test_long_chains_of_copies_converge(spark):
    n = 300
    rows = [(2 * i, "q", day(1), f"k{i}", f"{i}") for i in range(n)] + [(2 * i + 1, "q", day(2), f"k{i}", f"{i + 1}") for i in range(n)]
    assert kept_copies(spark.createDataFrame(rows, BOX)).collect()[0].delivery_no == 0
    hot = [(i, "q", None, "same", None) for i in range(500)]
    assert repeated_deliveries(spark.createDataFrame(hot, BOX)).count() == 499


def test_hot_and_missing_identifiers(spark):
    rows = [(i, "q", day(1 + i % 3), "hot", f"{i}") for i in range(60)] + [(100 + i, "q", None, None, None) for i in range(60)]
    rows += [(200, "q", day(1), None, "59"), (201, None, day(1), "\tHOT ", None), (202, None, day(1), None, "59")]
    assert {r.delivery_no for r in kept_copies(spark.createDataFrame(rows, BOX)).collect()} == {0, 202, *range(100, 160)}


def test_drain_keeps_one_copy_across_batches(spark, tmp_path):
    source, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for part in ([("a", 1), ("b", 1), (None, 1)], [("a", 2), ("c", 2), ("c", 2), (None, 2)]):
        spark.createDataFrame(part, "id string, n int").coalesce(1).write.mode("append").parquet(source)
        drain(read_stream(spark, source, spark.read.parquet(source).schema), out, state, "id").awaitTermination()
    assert sorted(str(r.id) for r in spark.read.parquet(out).collect()) == ["None", "None", "a", "b", "c"]
