"""Cascading erasure against plain Python over the whole tables."""

import hashlib
import math
import zlib
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import erasure, queries

DATA = "/root/testdata/sf0.001"
AMOUNT = {"clients": "balance", "clicks": "value", "sales": "total", "sale_lines": "amount"}


def crc(x):
    return zlib.crc32(("" if x is None else str(x)).encode())


def nulls_first(row):
    return tuple((x is not None, x if x is not None else 0) for x in row)


def brute(tables, files=350):
    """The files that are left, by table and number: rows, and how many were erased; tables: name to (columns, rows)."""
    at = {t: {c: i for i, c in enumerate(columns)} for t, (columns, _) in tables.items()}
    get = lambda t, r, c: r[at[t][c]]
    owner = {}
    for r in tables["sales"][1]:
        s, c = get("sales", r, "sale_id"), get("sales", r, "client_id")
        if s is not None:
            owner[s] = c if owner.get(s) is None else min(owner[s], c) if c is not None else owner[s]
    whose = {"clients": lambda r: get("clients", r, "client_id"), "clicks": lambda r: get("clicks", r, "client_id"), "sales": lambda r: get("sales", r, "client_id"), "sale_lines": lambda r: owner.get(get("sale_lines", r, "sale_id"))}
    clicked = {}
    for r in tables["clicks"][1]:
        clicked[get("clicks", r, "client_id")] = clicked.get(get("clicks", r, "client_id"), 0) + 1
    clicked.pop(None, None)
    people = {}
    for r in tables["clients"][1]:
        if get("clients", r, "master_id") is not None:
            people.setdefault(get("clients", r, "master_id"), set()).add(get("clients", r, "client_id"))
    busy = {m: sum(clicked.get(c, 0) for c in cs) for m, cs in people.items()}
    masters = {m for m in people if crc(m) % 400 == 0} | ({min(busy, key=lambda m: (-busy[m], m))} if busy else set())
    gone = set().union(*(people[m] for m in masters)) - {None} if masters else set()
    sold = {get("sales", r, "sale_id") for r in tables["sales"][1] if get("sales", r, "client_id") in gone} - {None}
    hit = {"clients": lambda r: get("clients", r, "master_id") in masters, "clicks": lambda r: get("clicks", r, "client_id") in gone, "sales": lambda r: get("sales", r, "client_id") in gone, "sale_lines": lambda r: get("sale_lines", r, "sale_id") in sold}
    out = {}
    for t, (_, rows) in tables.items():
        ordered = sorted(rows, key=lambda r: (crc(whose[t](r)), nulls_first(r)))  # noqa: B023
        per = 1 + len(ordered) // files
        for f in range(math.ceil(len(ordered) / per)):
            cut = ordered[f * per : (f + 1) * per]
            left = [r for r in cut if not hit[t](r)]
            if left:
                out[t, f] = left, len(cut) - len(left)
    return out


def loaded(frames):
    return {t: (df.columns, [tuple(r) for r in df.collect()]) for t, df in frames.items()}


def check(result, frames, folder=None, files=350):
    tables = loaded(frames)
    want = brute(tables, files)
    got = {(r.table_name, r.file_no): r for r in result.collect()}
    assert got.keys() == want.keys()
    for k, (rows, erased) in want.items():
        r = got[k]
        columns = tables[k[0]][0]
        cents = sum(math.floor(100 * x + 0.5) for row in rows if (x := row[columns.index(AMOUNT[k[0]])]) is not None)
        ids = hashlib.sha256(",".join("" if row[0] is None else str(row[0]) for row in rows).encode()).hexdigest()
        assert (r.n_rows, r.n_erased, r.cents, r.rewritten, r.ids_sha256, r.columns) == (len(rows), erased, cents, erased > 0, ids, ",".join(columns)), k
        file = pq.ParquetFile(r.path.removeprefix("file:"))
        assert file.schema_arrow.names == columns
        assert nulls_same([tuple(x.values()) for x in file.read().to_pylist()]) == nulls_same(rows)
        first = [row[0] for row in rows if row[0] is not None]
        stats = [file.metadata.row_group(i).column(0).statistics for i in range(file.metadata.num_row_groups)]
        if first and isinstance(first[0], int):
            assert (min(s.min for s in stats if s.has_min_max), max(s.max for s in stats if s.has_min_max)) == (min(first), max(first))
    paths = {Path(r.path.removeprefix("file:")) for r in got.values()}
    if folder is None and paths:
        folder = next(iter(paths)).parents[2]
    if folder:
        assert {p for p in Path(folder).rglob("*") if p.is_file() and p.suffix == ".parquet"} == paths
    return got


def nulls_same(rows):
    return [tuple("nan" if isinstance(x, float) and math.isnan(x) else x.replace(tzinfo=None) if isinstance(x, datetime) else x for x in r) for r in rows]


def test_query_against_brute_force(spark):
    frames = {t: spark.read.parquet(f"{DATA}/{t}.parquet") for t in AMOUNT}
    got = check(queries.op12_cascading_erasure(spark, DATA), frames)
    assert any(r.rewritten for r in got.values()) and not all(r.rewritten for r in got.values())


CLIENTS = "client_id long, master_id long, name string, balance double, file_no string"
CLICKS = "click_id long, client_id long, value double, _rank string"
SALES = "sale_id long, client_id long, total double"
LINES = "sale_id long, line_no int, amount double, client_id string"


def shop(spark, clients, clicks, sales, lines):
    make = lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3) if rows else spark.createDataFrame([], schema)
    return {"clients": make(clients, CLIENTS), "clicks": make(clicks, CLICKS), "sales": make(sales, SALES), "sale_lines": make(lines, LINES)}


def small(spark):
    clients = [(i, 1000 + i // 2, f"n{i}", i / 3, "f") for i in range(40)] + [(None, 1003, None, None, None), (50, None, "x", -1.005, None), (6, 1003, "again", 0.0, "f"), (6, 1003, "again", -0.0, "f")]
    clicks = [(i, i % 17, i / 7, None) for i in range(90)] + [(None, None, None, None)] * 5 + [(3, 6, 1.0, "r")] * 400  # a hot client, of equal rows
    sales = [(i, i % 23 if i % 5 else None, i / 9) for i in range(120)] + [(None, 6, 2.5), (7, 6, 1.0)]
    lines = [(i % 90, i, i / 11, "c") for i in range(300)] + [(6, 1, 2.0, None)] * 500 + [(None, None, None, None)] * 9 + [(999, 1, 5.5, "no sale")]
    return clients, clicks, sales, lines


@pytest.mark.parametrize("hot", [1000, 1])
def test_edges(spark, monkeypatch, tmp_path, hot):
    """Nulls in all columns, equal rows, hot keys (decided by lists, or with hot = 1 none), columns whose names clash."""
    monkeypatch.setattr(erasure, "HOT", hot)
    frames = shop(spark, *small(spark))
    got = check(erasure.erase_shop(frames, str(tmp_path / "e"), 12), frames, tmp_path / "e", 12)
    assert sum(r.n_erased for r in got.values()) > 0


def test_empty_tables(spark, tmp_path):
    clients, clicks, sales, lines = small(spark)
    for i, given in enumerate([([], [], [], []), ([], clicks, sales, lines), ([(1, None, "x", 1.0, None)], clicks, sales, lines)]):
        frames = shop(spark, *given)
        check(erasure.erase_shop(frames, str(tmp_path / str(i)), 5), frames, tmp_path / str(i), 5)


def test_files_that_lose_all_go_and_others_stay(spark, tmp_path):
    """One table: untouched files keep their names, a file without survivors is removed."""
    rows = spark.range(1000).select("id", (F.col("id") % 10).alias("k")).withColumn("_tie", F.monotonically_increasing_id())
    table = erasure.store(rows, F.col("id"), "_tie", str(tmp_path / "t"), 100)
    before = {p.parent.name: p.name for p in (tmp_path / "t").rglob("*.parquet")}
    assert table.per_file == 11 and len(before) == 91
    gone = spark.range(22, 40).select("id")
    assert erasure.erase(table, "id", gone) == {2: 11, 3: 7}
    after = {p.parent.name: p.name for p in (tmp_path / "t").rglob("*.parquet")}
    assert before.keys() - after.keys() == {"file_no=2"} and {k for k in after if after[k] != before[k]} == {"file_no=3"}
    assert sorted(r.id for r in table.rows().collect()) == [*range(22), *range(40, 1000)]
    assert erasure.erase(table, "id", spark.range(0).select("id")) == {}
