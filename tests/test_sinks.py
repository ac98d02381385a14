"""Files, folders, collections and topics."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from skylag import schemas
from skylag.operators import features as feat
from skylag.sinks import files
from skylag.sources import tables, topics


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 100, numPartitions=4).select(
        F.concat(F.lit("A"), F.col("id") % 7).alias("Origin"),
        F.concat(F.lit("B"), F.col("id") % 11).alias("Dest"),
        F.col("id").cast("double").alias("Distance"),
    )


def parts(path, suffix):
    return glob.glob(f"{path}/part-*{suffix}")


def test_json_files(spark, rows, tmp_path):
    out = str(tmp_path / "j")
    files.write_json(rows, out)
    assert len(parts(out, ".json")) == 4
    files.write_json(rows, out, files=1)
    assert len(parts(out, ".json")) == 1
    files.write_json(rows, out, compression="bzip2")
    assert len(parts(out, ".bz2")) == 4 and not parts(out, ".json")
    assert tables.read_distances(spark, out, "json").count() == 100


def blocks(path):
    """How bzip2 files begin, which names the size of their blocks."""
    return {open(name, "rb").read(4) for name in parts(path, ".json.bz2")}


def test_bzip2_is_packed_in_small_blocks_and_read_at_any_of_them(spark, tmp_path):
    out = str(tmp_path / "a b%20c")
    df = spark.range(40000, numPartitions=2).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    files.write_json(df, out, compression="bzip2")
    assert blocks(out) == {b"BZh1"} and sorted(os.listdir(out))[0] == "_SUCCESS"
    assert len(os.listdir(out)) == 3
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "50000")
    try:
        again = spark.read.schema("id long, text string").json(f"file://{out}")
        assert again.rdd.getNumPartitions() > 10
        assert again.count() == 40000 and again.exceptAll(df).isEmpty()
    finally:
        spark.conf.set(name, before)


def test_bzip2_holds_the_same_lines_as_plain_json(spark, tmp_path):
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    df = spark.sql(
        """SELECT * FROM VALUES (1, 'a\\n"b"\u00e9', TIMESTAMP_NTZ'2024-01-02 03:04:05.25', DATE'2024-01-02', 1.5D),
        (NULL, NULL, NULL, NULL, NULL), (3, '', TIMESTAMP_NTZ'2024-01-02 00:00:00', NULL, DOUBLE('NaN')) AS t(i, s, t, d, x)"""
    )
    for times in (1, 2):
        many = df.repartition(3) if times == 1 else df.limit(1)
        files.write_json(many, plain)
        files.write_json(many, packed, compression="bzip2")
        lines = [sorted(r.value for r in spark.read.text(p).collect()) for p in (plain, packed)]
        assert lines[0] == lines[1] and len(lines[1]) == (3 if times == 1 else 1)
    files.write_json(df.where("false"), packed, compression="bzip2")
    assert spark.read.schema(df.schema).json(packed).count() == 0


def test_like_rows_lie_together_in_their_partition(spark):
    df = spark.range(1000, numPartitions=3).select(
        F.col("id"), F.spark_partition_id().alias("p"),
        *[((F.col("id") * 7919 + i) % 11).alias(c) for i, c in enumerate(feat.SORT_KEYS)],
    )
    found = feat.alike_together(df).withColumn("now", F.spark_partition_id()).collect()
    assert {r["id"] for r in found} == set(range(1000)) and all(r["p"] == r["now"] for r in found)
    for part in range(3):
        keys = [[r[c] for c in feat.SORT_KEYS] for r in found if r["p"] == part]
        assert keys == sorted(keys)


def test_bzip2_files_stay_when_a_job_fails(spark, rows, tmp_path):
    out = str(tmp_path / "kept")
    files.write_json(rows, out, compression="bzip2")
    before = sorted(os.listdir(out))
    with pytest.raises(Exception, match="stop here"):
        files.write_json(
            spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("stop here"))).otherwise(F.col("id")).alias("i")),
            out, compression="bzip2",
        )
    assert [n for n in sorted(os.listdir(out)) if n != "_temporary"] == before
    assert tables.read_distances(spark, out, "json").count() == 100


def test_bzip2_goes_where_only_spark_writes(spark, rows, tmp_path):
    (tmp_path / "there").mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.bz.link./out", f"file://{tmp_path}/there")
    files.write_json(rows, "viewfs://bz/out/j", compression="bzip2")
    assert blocks(tmp_path / "there" / "j") == {b"BZh9"}
    assert tables.read_distances(spark, "viewfs://bz/out/j", "json").count() == 100


def test_a_day_is_replaced_alone_and_also_by_nothing(spark, tmp_path):
    out = str(tmp_path / "days")
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "Carrier string, d string")
    files.write_days(df, out, "d")
    files.write_daily(df.select("Carrier").where("Carrier = 'none'"), out, "2024-01-01")
    assert tables.read_requests(spark, out, "2024-01-01").count() == 0
    assert [r["Carrier"] for r in tables.read_requests(spark, out, "2024-01-02").collect()] == ["b"]
    files.write_days(df.where("Carrier = 'a'").withColumn("Carrier", F.lit("c")), out, "d")
    assert [r["Carrier"] for r in tables.read_requests(spark, out, "2024-01-01").collect()] == ["c"]
    assert tables.read_requests(spark, out, "2024-01-02").count() == 1


def test_only_the_wanted_day_is_read(spark, tmp_path):
    out = str(tmp_path / "days")
    files.write_days(
        spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "Carrier string, d string"), out, "d"
    )
    wanted = tables.read_requests(spark, out, "2024-01-02")
    assert {f.split("/")[-2] for f in wanted.inputFiles()} == {"request_date=2024-01-02"}


def test_clustered_files_hold_key_ranges(spark, rows, tmp_path):
    out = str(tmp_path / "c")
    files.write_clustered(rows, out, ["Origin", "Dest"], files=3)
    ranges = (
        spark.read.parquet(out)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("Origin").alias("low"), F.max("Origin").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(ranges) == 3
    assert all(a["high"] <= b["low"] for a, b in zip(ranges, ranges[1:]))


def test_collections_append_and_filter_at_the_source(spark, rows, tmp_path):
    out = str(tmp_path / "col")
    files.append_collection(rows, out)
    files.append_collection(rows, out)
    assert tables.read_collection(spark, out).count() == 200
    found = tables.read_collection(spark, out, where=F.col("Origin") == "A1")
    plan = found.select("Dest")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Origin,A1)" in plan and "Distance" not in plan


def test_requests_go_to_a_topic_and_back(spark, rows, tmp_path):
    out = str(tmp_path / "topic")
    files.emit_requests(rows, out)
    sent = topics.read_topic(spark, out)
    assert sent.columns == schemas.TOPIC.fieldNames()
    row = sent.where("value like '%\"Distance\":99.0%'").first()
    assert row["key"] is None and row["topic"] == "topic"
    assert row["value"] == '{"Origin":"A1","Dest":"B0","Distance":99.0}'


def test_broker_options():
    assert topics.broker_options("t", "h:1") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t"}
    assert topics.broker_options("t", "h:1", "earliest")["startingOffsets"] == "earliest"


def test_text_lines_with_unknown_fields(spark, tmp_path):
    path = os.path.join(tmp_path, "r.txt")
    with open(path, "w") as f:
        f.write('{"Origin":"A","Dest":"B","Distance":1.0,"_id":{"$oid":"5"},"Route":"A-B"}\n')
    assert tuple(tables.read_json_text(spark, path, schemas.DISTANCES).first()) == ("A", "B", 1.0)


def test_view_by_sql_text(spark, rows):
    tables.register(spark, rows, "routes")
    assert spark.sql("SELECT count(*) AS n FROM routes WHERE Origin = 'A0'").first()["n"] == 15
