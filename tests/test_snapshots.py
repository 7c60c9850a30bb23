"""Tables of snapshots: upserts that touch their buckets alone, two writers, retention by day."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from pantry.operators import candidates as C
from pantry.sources import snapshots as S

CACHE = "id int, ref string, score double, kept string, expires_at timestamp, created_at timestamp"
OLD = dt.datetime(2024, 1, 1)


@pytest.fixture
def cache(spark, tmp_path):
    rows = [(i, f"r{i}", 0.5, f"k{i}", OLD, OLD) for i in range(40)]
    frame = spark.createDataFrame(rows, CACHE)
    table = S.SnapshotTable(spark, str(tmp_path / "cache"), frame.schema, S.by_bucket("id", 8))
    assert table.version() == 0 and table.read().collect() == []
    assert table.append_new(frame) == 1
    return table


def incoming(spark, *rows):
    return spark.createDataFrame(rows, "id int, ref string, score double, seq int")


def upsert(table, rows, n=8):
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return C.upsert_into(table, rows, "id", ["ref", "score"], now, n, order="seq")


def test_upsert_rewrites_touched_buckets_only(spark, cache):
    before = cache.parts()
    rows = incoming(spark, (3, "zz first", 1.0, 1), (3, "a last", 2.0, 2), (99, "new", 3.0, 1), (None, "no key", 1.0, 1))
    assert upsert(cache, rows) == 2
    touched = {str(r[0]) for r in rows.where("id is not null").select(S.by_bucket("id", 8)).collect()}
    after = cache.parts()
    assert all((after.get(b) == before.get(b)) == (b not in touched) for b in map(str, range(8)))
    got = {r["id"]: r for r in cache.read().collect()}
    later, now = dt.datetime(2024, 2, 2), dt.datetime(2024, 2, 1)
    text = {r["id"]: (r["e"], r["c"]) for r in cache.read().select("id", F.col("expires_at").cast("timestamp_ntz").alias("e"),
                                                                  F.col("created_at").cast("timestamp_ntz").alias("c")).collect()}
    assert len(got) == 41 and (got[3]["ref"], got[3]["kept"]) == ("a last", "k3") and (got[99]["ref"], got[99]["kept"]) == ("new", None)
    assert text[3][0] == text[99][0] == later and text[99][1] == now
    assert {r["id"] for r in cache.read(version=1).collect()} == set(range(40))  # the old version stays readable


def test_two_writers(spark, cache, monkeypatch):
    """The second writer commits between the first one's reading and its commit."""
    commit, calls = cache.commit, []
    other = S.SnapshotTable(spark, cache.root, cache.schema, cache.part)

    def late(base, changes):
        if not calls:
            calls.append(1)
            upsert(other, incoming(spark, (3, "other", 7.0, 1), (50, "other", 7.0, 1)))
        return commit(base, changes)

    monkeypatch.setattr(cache, "commit", late)
    assert upsert(cache, incoming(spark, (3, "mine", 8.0, 1), (60, "mine", 8.0, 1))) == 3
    got = {r["id"]: r["ref"] for r in cache.read().collect()}
    assert (got[3], got[50], got[60], len(got)) == ("mine", "other", "mine", 42)
    with pytest.raises(S.Conflict):
        other.commit(1, {})
    assert cache.version() == 3


def test_writers_of_other_buckets_keep_their_work(spark, cache, monkeypatch):
    ids = {b: next(i for i in range(40) if spark.range(i, i + 1).select(S.by_bucket(F.col("id").cast("int"), 8)).first()[0] == b) for b in (0, 1)}
    commit, writes = cache.commit, []
    other = S.SnapshotTable(spark, cache.root, cache.schema, cache.part)

    def late(base, changes):
        if len(writes) == 1 and cache.version() == 1:
            upsert(other, incoming(spark, (ids[1], "other", 7.0, 1)))
        return commit(base, changes)

    monkeypatch.setattr(cache, "commit", late)
    write = cache.write
    monkeypatch.setattr(cache, "write", lambda rows: writes.append(1) or write(rows))
    upsert(cache, incoming(spark, (ids[0], "mine", 8.0, 1)))
    assert len(writes) == 1  # committed again, not made again
    got = {r["id"]: r["ref"] for r in cache.read().collect()}
    assert (got[ids[0]], got[ids[1]]) == ("mine", "other")


def test_retention_reads_the_boundary_day_only(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1, 6) + dt.timedelta(hours=3 * i)) for i in range(80)] + [(100, None)]
    log = spark.createDataFrame(rows, "id int, ts timestamp").select("id", F.col("ts").cast("timestamp").alias("ts"))
    table = S.SnapshotTable(spark, str(tmp_path / "log"), log.schema, S.by_day("ts"))
    table.append_new(log)
    for day, part in table.parts().items():  # no other day's files are there to be read
        if day != "2024-01-04":
            shutil.move(part["path"].removeprefix("file:"), str(tmp_path / day))
    before = table.parts()
    assert S.drop_before(table, "ts", "2024-01-04 10:00:00") == sum(p["rows"] for d, p in before.items() if d < "2024-01-04") + 4
    after = table.parts()
    assert sorted(after) == sorted(d for d in before if d >= "2024-01-04") and S.UNDATED in after
    assert all(after[d] == before[d] for d in after if d != "2024-01-04") and after["2024-01-04"]["rows"] == 4
    assert S.drop_before(table, "ts", "2024-01-04 10:00:00") == 0 and table.version() == 2
