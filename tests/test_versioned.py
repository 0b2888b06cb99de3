"""Versioned tables: any order of batches, repeats and two writers give one table; only touched files are read."""

import itertools
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewright.sinks.files import Folder
from ridewright.sinks.versioned import VersionedTable

pytestmark = pytest.mark.usefixtures("interpreted")

NOON = datetime(2024, 5, 1, 12)
ROW = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("a", T.StringType()),
        T.StructField("b", T.IntegerType()),
        T.StructField("day", T.DateType()),
    ]
)
CHANGE = "id int, a string, b int, day date, at timestamp"
DAYS = [date(2024, 5, d) for d in (1, 2, 3)]


def at(seconds):
    return NOON + timedelta(seconds=seconds)


def plain(changes):
    """Registers by column: the value of the latest put or set after the latest removal."""
    puts, gone, cells = {}, {}, {}
    for kind, key, values, when in changes:
        if kind == "put":
            puts[key] = max(when, puts.get(key, when))
        if kind == "remove":
            gone[key] = max(when, gone.get(key, when))
        for name, value in values.items():
            if kind == "put" or value is not None:
                cells[key, name] = max((when, value), cells.get((key, name), (when, value)), key=lambda x: x[0])
    out = {}
    for key, when in puts.items():
        if when > gone.get(key, datetime.min):
            kept = {n: cells.get((key, n), (None, None)) for n in "ab"}
            out[key] = tuple(v if w is not None and w > gone.get(key, datetime.min) else None for w, v in kept.values())
    return out


def apply(table, batch, change, job="job"):
    kind, key, values, when = change
    rows = table.spark.createDataFrame([(key, values.get("a"), values.get("b"), DAYS[key % 3], when)], CHANGE)
    if kind == "put":
        table.put(rows, "at", job, batch)
    elif kind == "set":
        table.set(rows, "at", {"a": F.col("a"), "b": F.col("b")}, job, batch)
    else:
        table.remove(rows, "at", job, batch)


def content(table, **how):
    return {r.id: (r.a, r.b) for r in table.read(**how).collect()}


@pytest.mark.parametrize("dated", [None, "day"])
def test_any_order_of_changes(spark, folder, dated):
    rng = random.Random(7)
    for trial in range(2):
        changes = []
        for i, kind in enumerate(rng.choices(["put", "set", "remove"], [4, 3, 2], k=9)):
            values = {n: rng.choice([None, f"{n}{i}" if n == "a" else i]) for n in "ab"} if kind != "remove" else {}
            changes.append((kind, rng.randrange(3), values, at(rng.choice(range(100)) * 10 + i)))
        table = VersionedTable(spark, f"{folder}/{trial}", ROW, ["id"], dated)
        order = changes[:]
        rng.shuffle(order)
        for batch, change in enumerate(order):
            apply(table, batch, change)
            if batch == 5:
                assert table.compact(share=0)
        assert content(table) == plain(changes)
        for batch in (2, 8):  # once in the base, once pending
            apply(table, batch, ("put", 0, {"a": "again", "b": 0}, at(10_000)))
        assert content(table) == plain(changes)
        assert table.compact(share=0) and content(table) == plain(changes)
        table.vacuum()
        assert content(table) == plain(changes)


def test_two_writers_lose_nothing(spark, folder):
    left, right = (VersionedTable(spark, folder, ROW, ["id"]) for _ in range(2))
    for batch in range(2):
        apply(left, batch, ("put", batch, {"a": "l", "b": 1}, at(batch)), job="left")
        apply(right, batch, ("set", batch, {"b": 2}, at(batch + 5)), job="right")
    assert content(left) == {0: ("l", 2), 1: ("l", 2)}
    # both compact the same changes: one list is published, the other folder goes
    assert left.compact(share=0) and not right.compact(share=0)
    assert content(right) == content(left) == {0: ("l", 2), 1: ("l", 2)}


def test_a_compaction_that_comes_second_publishes_nothing(spark, folder, monkeypatch):
    table = VersionedTable(spark, folder, ROW, ["id"])
    apply(table, 0, ("put", 1, {"a": "x", "b": 1}, at(0)))
    assert table.compact(share=0)
    apply(table, 1, ("put", 2, {"a": "y", "b": 1}, at(0)))
    late = VersionedTable(spark, folder, ROW, ["id"])
    seen = late.snapshot()
    assert table.compact(share=0)
    monkeypatch.setattr(VersionedTable, "snapshot", lambda self: seen)
    assert not late.compact(share=0)
    monkeypatch.undo()
    assert content(table) == {1: ("x", 1), 2: ("y", 1)}


def test_an_unfinished_batch_is_not_read(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"])
    apply(table, 0, ("put", 1, {"a": "x", "b": 1}, at(0)))
    apply(table, 1, ("put", 1, {"a": "y", "b": 1}, at(1)))
    Folder(spark, folder).remove("changes/job=job/batch=1/_SUCCESS")
    assert content(table) == {1: ("x", 1)}
    apply(table, 1, ("put", 1, {"a": "z", "b": 1}, at(1)))
    assert content(table) == {1: ("z", 1)}
    Folder(spark, folder).claim("versions/00000001.json", '{"number": 1, "par')
    assert content(table) == {1: ("z", 1)}


def rows(spark, ids, a="x"):
    return spark.createDataFrame([(i, a, i, DAYS[i % 3], NOON) for i in ids], CHANGE)


def test_a_batch_reads_and_writes_only_what_it_touches(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"], "day")
    table.put(rows(spark, range(30)), "at", "load", 0)
    table.compact(share=0)
    before = set(table.read().inputFiles())
    day_one = rows(spark, [1]).select("day")
    scan = table.read(keys=day_one)
    assert {f.split("part=")[1].split("/")[0] for f in scan.inputFiles()} == {"2024-05-02"}
    assert {r.id for r in scan.collect()} == set(range(1, 30, 3))
    table.put(rows(spark, [1], "new"), F.lit(at(1)), "load", 1)
    assert {f.split("part=")[1].split("/")[0] for f in set(table.read().inputFiles()) - before} == {"2024-05-02"}
    table.compact(share=0)
    after = set(table.read().inputFiles())
    assert {f for f in after if "part=2024-05-02" not in f} == {f for f in before if "part=2024-05-02" not in f}
    assert content(table)[1] == ("new", 1) and len(content(table)) == 30
    assert not table.compact(share=0)


def test_untouched_parts_are_scanned_without_a_shuffle(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"], "day")
    table.put(rows(spark, range(30)), "at", "load", 0)
    table.compact(share=0)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_parts_grow_with_the_table(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"], part_bytes=12_000)
    for batch, lo in enumerate((0, 400, 800)):
        table.put(rows(spark, range(lo, lo + 400)), "at", "load", batch)
        assert len(content(table)) == lo + 400
        table.compact(share=0)
        assert len(content(table)) == lo + 400
    snapshot = table.snapshot()
    assert 1 < len(snapshot.parts) <= snapshot.buckets
    # a batch cut for fewer parts is merged with the parts that hold its keys now
    one = rows(spark, [5], "late")
    table.put(one, F.lit(at(9)), "load", 3)
    got = table.read(keys=one)
    assert [(r.id, r.a) for r in got.collect()] == [(5, "late")]
    assert len({f for f in got.inputFiles() if "/base/" in f}) == 1


def test_replaced_parts_lose_rows_that_are_not_given(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"], "day")
    table.put(rows(spark, range(6)), "at", "stats", 0)
    table.replace_part(DAYS[0], rows(spark, [3], "new"), F.lit(at(1)), "stats", 1)
    assert {i: a for i, (a, _) in content(table).items()} == {1: "x", 2: "x", 3: "new", 4: "x", 5: "x"}
    table.replace_part(DAYS[1], rows(spark, []), F.lit(at(2)), "stats", 2)
    assert sorted(content(table)) == [2, 3, 5]


def test_forgotten_removals(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"])
    for batch, change in enumerate([("put", 1, {"a": "x"}, at(0)), ("remove", 1, {}, at(1)), ("put", 2, {"a": "y"}, at(2))]):
        apply(table, batch, change)
    table.compact(share=0, forget=F.lit(at(60)))
    stored = spark.read.parquet(f"{folder}/base")
    assert [r.id for r in stored.collect()] == [2]
    assert list(itertools.islice(content(table), 2)) == [2]


def test_null_days_have_a_part(spark, folder):
    table = VersionedTable(spark, folder, ROW, ["id"], "day")
    table.put(spark.createDataFrame([(1, "x", 1, None, NOON)], CHANGE), "at", "load", 0)
    assert content(table) == {1: ("x", 1)} == content(table, parts=[None])
    assert content(table, parts=[DAYS[0]]) == {}
