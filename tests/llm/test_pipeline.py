"""The pipeline's stages, each against a plain version on what its predecessor kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from millrace.llm import mixing, toxicity
from millrace.llm.queries import toxicity_fold

from .test_operators import WORDS, brute_components, brute_hits, brute_sets


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd, out = random.Random(11), str(tmp_path_factory.mktemp("tables"))
    say = lambda n: " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "."]) for _ in range(n))
    items = [say(30) for _ in range(4)]
    passage = say(60)
    texts = []
    for i in range(160):
        t = say(rnd.randint(10, 80))
        if i % 8 == 0:
            t = t.replace(" ", " idiot ", 1) + " you moron."
        if i % 9 == 1:
            t += " " + items[i % 4]
        if i % 10 == 3:
            t += "\n" + passage + " " + say(20)
        texts.append(t)
    texts += [texts[5], texts[5] + " more", texts[7] + " end", passage, "", None]
    rows = [(i, t, "en", f"src{i % 4}" if i % 11 else None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[0])


def cut(rows, length=50):
    """Each text without the bytes that an earlier document's strings cover."""
    first, out = {}, []
    for k, t, *_ in sorted(rows):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], k)
    for k, t, *rest in rows:
        b = (t or "").encode()
        gone = set()
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < k:
                gone |= set(range(i, i + length))
        if not gone:
            out.append((k, t, *rest))
        elif kept := bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore"):
            if kept.strip(" \t\n\x0b\x0c\r"):
                out.append((k, kept, *rest[:-1], len(kept)))
    return out


def test_stages(spark, sf_dir):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, stages = docs.columns, dict(P.STAGES)

    model = toxicity.train(docs, labels, toxicity_fold())
    lexicon = model.lexicon()
    rows = rows_of(docs)
    want = [r for r in rows if toxicity.score(model, lexicon, r[1]) < 0.5]
    got = P.written(stages["toxicity"](spark, docs, sf_dir), "t")
    assert got.columns == columns and rows_of(got) == want
    assert {r[0] for r in rows} - {r[0] for r in want} == {i for i in range(160) if i % 8 == 0}

    comps = brute_components(brute_sets([r[1] for r in want]))
    want = [r for i, r in enumerate(want) if comps[i] == i]
    got = P.written(stages["near_duplicates"](spark, got, sf_dir), "n")
    assert got.columns == columns and rows_of(got) == want

    want = cut(want)
    got = P.written(stages["suffix_dedup"](spark, got, sf_dir), "s")
    assert got.columns == columns and rows_of(got) == want

    def bad(t):
        n, hit, _ = brute_hits(t, items)
        return hit > 0 and 20 * hit >= n

    assert any(bad(r[1]) for r in want)
    want = [r for r in want if not bad(r[1])]
    got = P.written(stages["decontamination"](spark, got, sf_dir), "d")
    assert got.columns == columns and rows_of(got) == want

    mixed = stages["mixing"](spark, got, sf_dir).collect()
    size = {r[0]: len((r[1] or "").split()) for r in want}
    assert {r["doc_id"]: r["size"] for r in mixed} == size
    totals = {}
    for r in want:
        totals[r[3]] = totals.get(r[3], 0) + size[r[0]]
    goal = mixing.targets(totals)
    source = {r[0]: r[3] for r in want}
    for s in totals:
        own = [r for r in mixed if source[r["doc_id"]] == s]
        assert own[0]["target"] == pytest.approx(goal[s])
        assert abs(sum(r["taken"] for r in own) - goal[s]) <= max(40, 0.02 * goal[s])

    assert rows_of(P.run(spark, sf_dir)) == rows_of(stages["mixing"](spark, got, sf_dir))


def test_stages_leave_other_columns_alone(spark, sf_dir):
    """Columns with the names that operators use themselves, nulls in every column, repeated rows, a very long text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (5000, "w " * 300_000, "en", "src1", 600_000), (5001, "", None, "src1", 0)], docs.schema)
    clash = ["score", "predicted", "_id", "kept_text", "_bad", "_stay", "component_id", "part", "c0", "size"]
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id = 7")).select("*", *(F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in clash))
    for name, stage in P.STAGES[:-1]:
        before, docs = docs.count(), P.written(stage(spark, docs, sf_dir), name)
        rows = docs.collect()
        assert docs.columns[5:] == clash and 0 < len(rows) <= before
        assert all(r[c] == (None if r["doc_id"] is None else f"{c}-{r['doc_id']}") for r in rows for c in clash)
        assert sum(r["doc_id"] is None for r in rows) == 1 and sum(r["doc_id"] == 5001 for r in rows) == 1
    mixed = P.STAGES[-1][1](spark, docs, sf_dir)
    assert mixed.count() == docs.count()


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_labels_fold_is_by_key(spark):
    rows = spark.range(20).withColumnRenamed("id", "doc_id").where(toxicity_fold()).collect()
    import zlib

    assert [r["doc_id"] for r in rows] == [i for i in range(20) if zlib.crc32(str(i).encode()) % 5]
