"""Search by index, indexes by frequency and tables along a curve."""

import math
import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from skylag.operators import lookups, ranks, text_index
from skylag.sinks import zorder
from skylag.sources import testbed

DOCS = [
    ("N1", "Red red  wing", "big"), ("N2", "red", "BIG jet"), ("N3", "blue-wing", None), ("N4", "", "big"), (None, "red", "big"),
    ("N5", "red wing " * 50, "small"), ("N6", "Ünï red", "jet big big"), ("N7", None, None),
]


def _brute(query):
    def words(text):
        return [w for w in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]

    scores = {}
    for place, text in query.items():
        docs = {d[0]: words(d[place]) for d in DOCS if d[0] and words(d[place])}
        average = sum(map(len, docs.values())) / len(docs)
        found = {}
        for word in dict.fromkeys(words(text)):
            df = sum(word in ws for ws in docs.values())
            for key, ws in docs.items():
                tf = ws.count(word)
                if tf:
                    idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                    found[key] = found.get(key, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / average))
        scores = {k: scores.get(k, 0) + s for k, s in found.items() if not scores or k in scores}
    return {k: round(s, 9) for k, s in scores.items()}


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    docs = spark.createDataFrame(DOCS, "TailNum string, Owner string, Model string")
    text_index.build_index(docs, path, "TailNum", ["Owner", "Model"], buckets=4)
    return path, docs


@pytest.mark.parametrize("query", [{1: "red"}, {1: "RED wing"}, {1: "red", 2: "big jet"}, {1: "ünï"}, {2: "none"}, {1: "blue nothing", 2: ""}])
def test_scores_are_those_of_the_formula(spark, index, query):
    path, _ = index
    fields = {("Owner" if i == 1 else "Model"): text for i, text in query.items()}
    got = {r.key: r.Relevance for r in text_index.hits(spark, path, **fields).collect()}
    want = _brute({i: t for i, t in query.items() if t})
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-8) for k in want)


def test_the_best_come_first_and_no_word_finds_nothing(spark, index):
    path, docs = index
    want = sorted(_brute({1: "red wing"}).items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    rows = text_index.top(spark, path, docs, "TailNum", 3, Owner="red wing").collect()
    assert [r.TailNum for r in rows] == [k for k, _ in want]
    assert text_index.hits(spark, path, Owner=" - ", Model=None).count() == 0


def test_a_search_reads_the_folders_of_its_words(spark, index):
    path, _ = index
    plan = text_index.postings(spark, path, {"Owner": "wing"})._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    assert "EqualTo(word,wing)" in plan or "In(word, [wing])" in plan


def test_airplanes_found_by_index_are_those_found_by_scan(spark, sf_dir, tmp_path):
    planes, path = testbed.airplanes(spark, sf_dir), str(tmp_path / "index")
    lookups.index_airplanes(planes, path)
    words = planes.first().Owner.split()[0]
    by_scan = lookups.search_airplanes(planes, Owner=words, Manufacturer="maker")
    by_index = lookups.indexed_airplanes(spark, path, planes, Owner=words, Manufacturer="maker")
    assert sorted(r.TailNum for r in by_scan.collect()) == sorted(r.TailNum for r in by_index.collect()) != []
    assert lookups.indexed_airplanes(spark, path, planes).count() == planes.count()


def test_places_are_a_total_order(spark):
    dice = random.Random(2)
    values = [dice.choice([None, *range(20)]) for _ in range(500)]
    rows = ranks.ranked(spark.createDataFrame([(v,) for v in values], "v int").repartition(5), [F.col("v").asc_nulls_first()])
    got = sorted((r["rank"], r.v) for r in rows.collect())
    assert [v for _, v in got] == sorted(values, key=lambda v: (v is not None, v or 0)) and [i for i, _ in got] == list(range(500))
    assert ranks.ranked(rows.limit(0).drop("rank"), [F.col("v").asc()]).count() == 0


def test_frequency_index_is_that_of_the_indexer(spark):
    dice = random.Random(4)
    values = [dice.choice(["a", "a", "b", "é", "", "zz", f"v{dice.randint(0, 40)}"]) for _ in range(800)]
    rows = spark.createDataFrame([(v,) for v in values], "label string")
    index = ranks.frequency_index(rows.union(spark.createDataFrame([(None,)], "label string")), "label")
    fitted = StringIndexer(inputCol="label", outputCol="p", handleInvalid="keep").fit(rows)
    assert [r.label for r in index.orderBy("position").collect()] == fitted.labels
    asked = spark.createDataFrame([("a",), ("unseen",), (None,)], "label string")
    want = {r.label: r.p for r in fitted.transform(asked).collect()}
    assert {r.label: r.at for r in ranks.with_index(asked, index, "label", "at").collect()} == want
    assert [r.label for r in ranks.with_index(asked, index, "label", "at", "skip").collect()] == ["a"]
    with pytest.raises(Exception, match="no index of label"):
        ranks.with_index(asked, index, "label", "at", "error").collect()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zorder"))
    flights = testbed.flights(spark, sf_dir).withColumn("Dest", F.when(F.col("Dest") != "A07", F.col("Dest")))
    zorder.write_zordered(flights, path, ["Origin", "Dest"], files=16)
    return path, flights.cache()


@pytest.mark.parametrize("keys", [{"Dest": "A15"}, {"Origin": "A03"}, {"Origin": "A03", "Dest": "A15"}, {"Dest": None}, {"Dest": "none"}, {}])
def test_lookups_by_any_key_read_few_files(spark, stored, keys):
    path, flights = stored
    want = flights
    for name, value in keys.items():
        want = want.where(F.col(name).eqNullSafe(F.lit(value)))
    assert zorder.lookup(spark, path, **keys).exceptAll(want).count() == 0
    assert zorder.lookup(spark, path, **keys).count() == want.count()
    read, all_files = len(zorder.lookup_files(spark, path, **keys)), len(zorder.lookup_files(spark, path))
    assert all_files >= 14 and (read == all_files if not keys else read <= all_files // 2)


def test_the_curve_interleaves_bits(spark):
    row = spark.range(1).select(zorder.curve([F.lit(0b11), F.lit(0b01)]).alias("z")).first()
    assert row.z == 0b1011


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 255])
def test_numbers_of_ranges_are_found_by_halving(spark, n):
    cuts = [f"k{2 * i:03d}" for i in range(n)]
    keys = [None, "", "k", *[f"k{i:03d}" for i in range(2 * n + 1)], "z"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").withColumn("n", zorder._number("k", cuts))
    assert {r.k: r.n for r in rows.collect()} == {k: sum(c <= k for c in cuts) if k is not None else 0 for k in keys}
    # Eight steps at most, not a test for each bound.
    assert rows._jdf.queryExecution().analyzed().toString().count("filter(") == 0


def test_a_table_along_the_curve_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    rows = spark.range(3000).selectExpr("id", "cast(id % 7 as string) AS k").mapInArrow(count, "id long, k string")
    zorder.write_zordered(rows, str(tmp_path / "z"), ["id", "k"], files=4)
    assert seen.value == 3000
    assert zorder.lookup(spark, str(tmp_path / "z"), k="3").count() == 429
