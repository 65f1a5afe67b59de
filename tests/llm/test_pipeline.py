"""The pipeline's stages against brute force, and the registered queries against SQL."""

import os

import pytest

from gaugeflow.llm import queries
from tests.llm.test_operators import SCHEMA, brute_classes, brute_hits, brute_removed, prose, texts  # noqa: F401
from verification.compare import _rows, connect

pipeline = pytest.importorskip("corpus_pipeline")
SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")


def test_stages(spark, texts, tmp_path):  # noqa: F811
    items = [(1, " ".join(prose(8, 90).split()[5:40]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, t, "en", "k", 1, "b", "c", "w") for i, t in texts] + [(20, prose(8, 90) + " " + prose(30, 9), "en", "k", 1, "b", "c", "w")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append([(r.doc_id, None if name == "packing" else r.text) for r in docs.collect()])
        assert name == "packing" or docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    # letters are needed
    assert {i for i, _ in seen[0]} == {r[0] for r in rows} - {6, 7, 8, 17}
    # one of each group, and one row of the repeated id
    once = list(dict(seen[0]).items())
    root = brute_classes([t for _, t in once])
    groups = {}
    for (i, _), r in zip(once, root, strict=True):
        groups.setdefault(r, []).append(i)
    least = {min((i for i in g if i is not None), default=None) for g in groups.values()}
    assert sorted(str(i) for i, _ in seen[1]) == sorted(map(str, least))
    # repeats go, judged on the stage's input
    kept = brute_removed([t for _, t in seen[1]], queries.WINDOW)
    wanted = {i: k for (i, _), k in zip(seen[1], kept, strict=True) if k}
    assert {i: t.encode().split() for i, t in seen[2]} == wanted
    # contaminated documents go
    clean = {i for i, t in seen[2] for n, hit, _ in [brute_hits(t, [("1", items[0][1])], 13)] if not (hit and 20 * hit >= n)}
    assert {i for i, _ in seen[3]} == clean
    assert {i for i, _ in seen[4]} == clean


def test_rows_without_or_with_one_id_are_told_apart(spark, tmp_path):
    """Different texts stay, whatever their ids; what one of them holds says nothing of the others."""
    items, shared = [(k, " ".join(prose(k, 90).split()[5:40])) for k in (8, 9)], prose(41, 40)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own = [prose(200 + i, 60) for i in range(6)]
    rows = [(None, own[0]), (None, own[1]), (None, own[1]), (None, own[2] + " " + shared), (7, own[3]), (7, own[4] + " " + shared),
            (7, own[3].upper()), (8, own[3]), (None, own[4] + " " + shared), (None, prose(8, 90)), (7, prose(9, 90))]
    frame = spark.createDataFrame([(i, t, "en", "k", 1, "b", "c", "w") for i, t in rows], SCHEMA)
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (_, stage) in enumerate(pipeline.STAGES[1:4]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=str))
    one = [t for i, t in seen[0] if t.lower() == own[3]]  # copies in other case: either row
    assert len(one) == 1
    left = [rows[0], rows[1], rows[3], (7, one[0]), rows[5], rows[9], rows[10]]
    assert seen[0] == sorted(left, key=str)
    cut = [(i, t.removesuffix(" " + shared)) for i, t in left]
    assert seen[1] == sorted(cut, key=str)
    assert seen[2] == sorted(cut[:5], key=str)


@needs_tables
def test_run(spark):
    assert pipeline.run(spark, SMALL).count() > 0


@needs_tables
@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_sql(spark, name):
    found = queries.QUERIES[name](spark, SMALL)
    cursor = connect(SMALL).execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert _rows(found.columns, found.collect()) == _rows(columns, cursor.fetchall())


@needs_tables
def test_held_out_figures(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in queries.language_ids(spark, SMALL).collect() if r.held_out]
    assert sum(langs[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
    scores = [r for r in queries.scored(spark, SMALL).collect() if r.held_out]
    assert sum(r.score for r in scores) > sum(r.base_score for r in scores)
