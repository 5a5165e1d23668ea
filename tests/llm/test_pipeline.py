"""The pipeline against a step-by-step answer on a small table, and SQL for the queries that have it."""

import random

import cases
import corpus_pipeline as P
import duckdb
import pytest

from lacuna.functions.durable import scratch_path
from lacuna.llm.quality import score_quality, train
from lacuna.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def sf_dir(spark):
    rng = random.Random(6)
    base = [(k, cases.prose(100 + k, 60)) for k in range(60)]
    junk = [(200 + k, " ".join(w + "!!" for w in cases.prose(700 + k, 50).split()).upper()) for k in range(30)]
    copies = [(300 + k, base[k][1]) for k in range(5)] + [(0, base[0][1]), (None, base[7][1])]
    near = []
    for k in range(10, 16):
        w = base[k][1].split()
        w[rng.randrange(60)] = "edited"
        near.append((400 + k, " ".join(w)))
    item = cases.prose(999, 25)
    leaks = [(500 + k, cases.prose(800 + k, 30) + " " + item + " " + cases.prose(900 + k, 10)) for k in range(3)]
    rows = base + junk + copies + near + leaks + [(600, None), (601, "")]
    path = scratch_path(spark, "tables").removeprefix("file:")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string"
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in base] + [(i, 0, 0) for i, _ in junk]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, item


def test_stages(spark, sf_dir):
    path, rows, item = sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{path}/labels.parquet"))
    good = {r.doc_id: r.predicted for r in score_quality(docs, model).collect()}
    left = [(i, t) for i, t in rows if good[i]]
    assert {i for i, _ in rows if not good[i]} >= set(range(200, 230)) and all(good[i] for i in range(60))

    def first_of(groups):
        return [min(members, key=lambda r: (r[0] is None, r[0] or 0)) for members in groups.values()]

    groups = {}
    for i, t in left:
        groups.setdefault(t or "", []).append((i, t))
    left = first_of(groups)
    groups = {}
    for (i, t), (_, n, c) in zip(left, cases.components(left, 5, 80)):
        groups.setdefault(c if n else ("none", i), []).append((i, t))
    left = first_of(groups)
    left = [r for r, x in zip(left, cases.contaminated(left, [(1, item)])) if not x[5]]

    got = P.run(spark, path)
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted((i for i, _ in left), key=repr)
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
    assert P.run.__module__ == "corpus_pipeline" and P.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert cases.rows_of(QUERIES[name](spark, sf).select(names)) == sorted(cursor.fetchall(), key=repr)
