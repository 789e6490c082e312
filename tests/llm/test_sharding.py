"""Feistel sharding against its own inverse, plain Python and the law of equal counts."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, sharding
from millrace.llm.sharding import Permutation

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 15, 16, 17, 100, 1009, 65536, 65537])
def test_permutation_is_one_and_goes_back(n):
    p = Permutation(n)
    rows = np.arange(n)
    places = p.place(rows)
    assert sorted(places.tolist()) == list(range(n))
    assert (p.row(places) == rows).all()
    a, b = p.sides
    assert n <= a * b < n + a + 1


def test_permutation_of_large_numbers_and_by_seed():
    p = Permutation(10**15 + 7)
    rows = np.random.default_rng(1).integers(0, p.n, 5000)
    assert (p.row(p.place(rows)) == rows).all()
    small = np.arange(5000)
    assert (Permutation(5000, 1).place(small) != Permutation(5000, 2).place(small)).mean() > 0.99
    with pytest.raises(ValueError):
        Permutation(1 << 62)


def test_neighbours_are_dealt_apart():
    places = Permutation(20_000).place(np.arange(20_000))
    together = (places[1:] % 16 == places[:-1] % 16).mean()
    assert 0.05 < together < 0.075  # one in sixteen, as by chance
    assert abs(np.corrcoef(np.arange(20_000), places)[0, 1]) < 0.03


def sharded(docs, **kw):
    return sharding.into_shards(sharding.measured(docs), ["key", "text_crc32", "size"], **kw)


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    made = [(i, "w" * rnd.randint(0, 40), "x") for i in range(300)]
    made += [(None, None, "x"), (None, "", "x"), (5, "other text", "x"), (7, None, "x"), (8, "é" * 100_000, "x")]
    made += [(11, "the same", "x")] * 400  # equal rows, over half of all
    return spark.createDataFrame(made, "doc_id long, text string, shard string")


def test_query_keeps_the_law_and_doesnt_depend_on_partitions(spark, rows):
    """The query's result on rows of all kinds, against plain Python, dealt in two ways."""
    first = sorted((str(tuple(r)) for r in sharded(rows.repartition(7), shards=16).drop("row_number").collect()))
    second = sorted((str(tuple(r)) for r in sharded(rows.repartition(3, F.rand(5)), shards=16).drop("row_number").collect()))
    assert first == second
    given = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows.collect()]
    given.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    places = Permutation(len(given)).place(np.arange(len(given))).tolist()
    want = sorted(str((k, size, crc, p % 16, p // 16)) for (k, size, crc), p in zip(given, places, strict=True))
    assert first != [] and want == first


def test_counts_and_slots(spark, rows):
    got = [(r.shard, r.slot) for r in sharded(rows, shards=16).collect()]
    by = [sorted(s for k, s in got if k == i) for i in range(16)]
    assert all(x == list(range(len(x))) for x in by) and max(map(len, by)) - min(map(len, by)) <= 1


def test_a_slot_leads_back(spark, rows):
    found = sharded(rows, shards=4)
    n = found.count()
    for r in found.where("slot % 50 = 3").collect():
        assert sharding.row_at(r.shard, r.slot, n, 4) == r.row_number
    with pytest.raises(IndexError):
        sharding.row_at(4, 0, n, 4)


def test_empty_and_one_row(spark, rows):
    assert sharded(rows.limit(0)).count() == 0
    assert [(r.shard, r.slot) for r in sharded(rows.where("doc_id = 3"), shards=16).collect()] == [(0, 0)]
    with pytest.raises(ValueError):
        sharded(rows, shards=0)


def test_shards_are_written_with_all_columns(spark, rows, tmp_path):
    sharding.write_shards(rows.select("doc_id", "text"), ["doc_id", "text"], str(tmp_path / "s"), shards=4)
    got = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, got.select("doc_id", "text").collect())) == sorted(map(str, rows.select("doc_id", "text").collect()))
    import pyarrow.parquet as pq

    for shard in range(4):
        files = sorted((tmp_path / "s" / f"shard={shard}").glob("*.parquet"))
        slots = [s for f in files for s in pq.ParquetFile(f).read(["slot"])["slot"].to_pylist()]
        assert slots == list(range(len(slots)))


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    got, want = queries.op11_feistel_shards(spark, DATA).toPandas(), con.sql(queries.ORACLE["op11_feistel_shards"]).df()
    order = ["doc_id", "size", "text_crc32", "shard", "slot", "row_number"]
    assert sorted(got.columns) == sorted(want.columns) and (want["law"] == "rows").all() and want["grown_shard"].isna().all()
    assert sorted(map(tuple, got[order].to_numpy().tolist())) == sorted(map(tuple, want[order].to_numpy().tolist()))


def test_query(spark):
    got = queries.op11_feistel_shards(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert got.count() == docs.count() and got.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = {r.doc_id: (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got.collect()} == want
