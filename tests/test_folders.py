"""Tables in folders: only what a write touches changes, and readers go on."""

import pytest
from pyspark.sql import functions as F

from skylag.operators import daystates
from skylag.operators import distances as dist
from skylag.schemas import DISTANCES
from skylag.session import get_text, names_in, put_text, scratch, work_path
from skylag.sinks import folders


def _routes(spark, rows):
    return spark.createDataFrame(rows, DISTANCES)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    folders.upsert_table(_routes(spark, [(f"A{i}", f"B{i % 7}", float(i)) for i in range(60)]), path, DISTANCES, dist.ROUTE, buckets=8)
    return path


def test_untouched_folders_keep_their_files_and_open_readers_go_on(spark, table):
    before = folders.read_folders(spark, table, DISTANCES)
    old = before.inputFiles()
    folders.upsert_table(_routes(spark, [("A3", "B3", 300.0)]), table, DISTANCES, dist.ROUTE)
    after = folders.read_folders(spark, table, DISTANCES)
    place = spark.range(1).select(folders.bucket_of([F.lit("A3"), F.lit("B3")], 8)).first()[0]
    kept = [f for f in old if f"_bucket={place}/" not in f]
    assert set(kept) < set(after.inputFiles()) and len(set(old) - set(after.inputFiles())) == len(old) - len(kept) >= 1
    assert before.where("Origin = 'A3'").first().Distance == 3.0 and before.count() == 60
    assert after.where("Origin = 'A3'").first().Distance == 300.0 and after.count() == 60
    assert folders.read_folders(spark, table, DISTANCES, commit=1).where("Distance = 300").count() == 0


def test_the_last_write_of_a_key_wins_and_null_keys_are_keys(spark, table):
    changes = [("A1", "B1", 1.5, 2), ("A1", "B1", 9.0, 1), (None, "B1", 7.0, 1), ("new", "B", None, 1)]
    rows = spark.createDataFrame(changes, "Origin string, Dest string, Distance double, at int")
    for _ in range(2):
        folders.upsert_table(rows, table, DISTANCES, dist.ROUTE, seq="at")
    got = {(r.Origin, r.Dest): r.Distance for r in folders.read_folders(spark, table, DISTANCES).collect()}
    assert len(got) == 62 and got[("A1", "B1")] == 1.5 and got[(None, "B1")] == 7.0 and got[("new", "B")] is None


def test_changes_of_single_keys_are_grouped_only_with_what_is_stored(spark, tmp_path, monkeypatch):
    grouped = []

    def upsert(*args):
        grouped.append(args)
        return dist.upsert(*args)

    monkeypatch.setattr(folders, "upsert", upsert)
    path = str(tmp_path / "table")
    rows = [("A", "B", 1.0), (None, "B", 2.0), (None, None, 3.0), ("A", "", 4.0), ("kept", "B", 5.0)]
    folders.upsert_table(_routes(spark, rows), path, DISTANCES, dist.ROUTE, buckets=1, once=True)
    assert not grouped and folders.read_folders(spark, path, DISTANCES).count() == 5
    changes = _routes(spark, [("A", "B", 10.0), (None, "B", None), (None, None, 30.0), ("new", "B", 6.0)])
    for _ in range(2):
        folders.upsert_table(changes, path, DISTANCES, dist.ROUTE, once=True)
    got = {(r.Origin, r.Dest): r.Distance for r in folders.read_folders(spark, path, DISTANCES).collect()}
    assert got == {("A", "B"): 10.0, (None, "B"): None, (None, None): 30.0, ("A", ""): 4.0, ("kept", "B"): 5.0, ("new", "B"): 6.0}


def test_a_key_is_read_from_its_folder_alone(spark, table):
    found = folders.lookup(spark, table, DISTANCES, Origin="A8", Dest="B1")
    assert [r.Distance for r in found.collect()] == [8.0]
    assert len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) == 1
    assert folders.lookup(spark, table, DISTANCES, Origin="A8", Dest="none").count() == 0


def test_a_crash_before_the_commit_changes_nothing(spark, table, monkeypatch):
    before = folders.read_folders(spark, table, DISTANCES).inputFiles()
    with monkeypatch.context() as broken:
        broken.setattr(folders, "put_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            folders.upsert_table(_routes(spark, [("A3", "B3", 300.0)]), table, DISTANCES, dist.ROUTE)
    assert folders.read_folders(spark, table, DISTANCES).inputFiles() == before
    writes = len([n for n in names_in(spark, table) if n.startswith("write=")])
    assert writes == 2 and folders.clean(spark, table, keep=1) and len(names_in(spark, table)) == 2
    assert folders.read_folders(spark, table, DISTANCES).count() == 60


def test_a_second_writer_fails(spark, table):
    put_text(spark, f"{table}/commits/{2:012d}", get_text(spark, f"{table}/commits/{1:012d}"))
    with pytest.raises(FileExistsError):
        put_text(spark, f"{table}/commits/{2:012d}", "other")


def test_rows_outside_the_folders_replaced_are_an_error(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "day string, n int")
    with pytest.raises(Exception, match="outside the folders"):
        folders.replace_folders(rows, str(tmp_path / "t"), "day", ["a"])


def test_states_of_days_merge_and_can_be_taken_back(spark, tmp_path):
    path = str(tmp_path / "states")
    rows = [("2024-01-01", "A", "B", 10.0), ("2024-01-01", "A", "B", 20.0), ("2024-01-02", "A", "B", 60.0), ("2024-01-02", "C", "D", None), ("2024-01-03", "E", "F", 5.0)]
    flights = spark.createDataFrame(rows, "FlightDate string, Origin string, Dest string, Distance double")

    def same(part):
        got = sorted(map(tuple, daystates.merged_distances(spark, path).collect()))
        return got == sorted(map(tuple, dist.route_distances(part).collect()))

    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    daystates.put_periods(flights.withColumn("Distance", F.lit(1.0)), path, days[:2])
    daystates.put_periods(flights, path, days[:2])
    assert same(flights.where("FlightDate < '2024-01-03'"))
    files = set(daystates.read_folders(spark, path, daystates._schema()).inputFiles())
    for _ in range(2):
        daystates.put_periods(flights, path, days[2:])
    assert same(flights) and files < set(daystates.read_folders(spark, path, daystates._schema()).inputFiles())
    rest = flights.where("FlightDate <> '2024-01-02'")
    daystates.put_periods(rest, path, days[1:2])
    assert same(rest)


def test_scratch_is_removed_at_the_end(spark):
    with scratch(spark):
        inside = work_path(spark, "inside")
        spark.range(3).write.parquet(inside)
        with scratch(spark):
            deeper = work_path(spark, "deeper")
            spark.range(3).write.parquet(deeper)
        assert names_in(spark, deeper) == [] and names_in(spark, inside)
    outside = work_path(spark, "outside")
    spark.range(3).write.parquet(outside)
    assert names_in(spark, inside) == [] and names_in(spark, outside)
