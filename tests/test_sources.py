"""Document dumps, catalog tables in buckets, the model as a table, splits by hash."""

import datetime as dt
import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from framewise.operators import frames as FR
from framewise.operators import metrics as M
from framewise.operators import model as ML
from framewise.plans import tables as TB
from framewise.sources import bindings as B
from framewise.sources import bson_dump as BD
from framewise.sources import catalog as SC
from framewise.streaming import incremental as INC

SCHEMA = ("n long, name string, image binary, flag boolean, score double, at timestamp, tags array<string>, "
          "inner struct<a:int,b:string>")


def some_docs(k):
    r = random.Random(k)
    for n in range(k):
        doc = {"n": n if n % 3 else float(n), "name": f"ñ{n}" * r.randrange(4), "image": r.randbytes(r.randrange(300)),
               "flag": n % 2 == 0, "score": n / 7, "at": dt.datetime(2020, 1, 1, 0, 0, n % 60, 123000), "tags": ["a", str(n)],
               "inner": {"a": n, "b": "x"}, "extra": {"deep": [1, {"image": b"no"}]}}
        for name in r.sample(sorted(doc), r.randrange(4)):
            if name != "n":
                doc[name] = r.choice([None, "other type"])
        yield doc


def expected(doc):
    ok = {"name": str, "image": bytes, "flag": bool, "score": float, "at": dt.datetime, "tags": list, "inner": dict}
    out = [int(doc["n"])]
    for name, kind in ok.items():
        v = doc[name] if isinstance(doc[name], kind) else None
        out.append(v)
    return out


def rows_of(df):
    return sorted(([r.n, r.name, None if r.image is None else bytes(r.image), r.flag, r.score, r["at"],
                    r.tags, None if r.inner is None else r.inner.asDict()] for r in df.collect()), key=lambda x: x[0])


@pytest.mark.parametrize("split", [1, 700, 5_000, 1 << 30])
def test_dump_splits_lose_and_repeat_nothing(spark, tmp_path, split):
    docs = list(some_docs(500))
    (tmp_path / "b.bson").write_bytes(b"".join(map(BD.encode, docs[:300])))
    (tmp_path / "a.bson").write_bytes(b"".join(map(BD.encode, docs[300:])))
    (tmp_path / "c.bson").write_bytes(b"")
    (tmp_path / "notes.txt").write_text("no dump")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    got = BD.scan_dump(spark, str(tmp_path), SCHEMA, split)
    assert rows_of(got) == sorted((expected(d) for d in docs), key=lambda x: x[0])
    splits = BD.split_file(str(tmp_path / "b.bson"), split)
    assert splits[0].start == 0 and all(a.end == b.start for a, b in zip(splits, splits[1:]))
    assert BD.split_file(str(tmp_path / "c.bson"), split) == []


def test_dump_filters_and_columns(spark, tmp_path):
    docs = list(some_docs(400))
    (tmp_path / "d.bson").write_bytes(b"".join(map(BD.encode, docs)))
    got = BD.scan_dump(spark, str(tmp_path / "d.bson"), SCHEMA, 3000)
    want = [expected(d) for d in docs]
    cases = {"n >= 250 AND n < 260": lambda r: 250 <= r[0] < 260, "flag IS NULL": lambda r: r[3] is None,
             "name = 'ñ7'": lambda r: r[1] == "ñ7", "n IN (3, 5, 1000)": lambda r: r[0] in (3, 5),
             "NOT flag AND length(name) > 2": lambda r: r[3] is False and r[1] is not None and len(r[1]) > 2,
             "score > 50": lambda r: r[4] is not None and r[4] > 50}
    for where, test in cases.items():
        assert [r.n for r in got.where(where).select("n").orderBy("n").collect()] == [r[0] for r in want if test(r)], where
    assert got.where("n = 5").count() == 1 and got.select("inner.a").where("a = 9").count() <= 1


def test_damaged_dump_is_an_error(spark, tmp_path):
    good = b"".join(map(BD.encode, some_docs(20)))
    for raw in (good + b"\x05", good + b"\x00\x00\x00\x00junk", good[:-3]):
        (tmp_path / "x.bson").write_bytes(raw)
        with pytest.raises(Exception, match="no document at byte"):
            BD.scan_dump(spark, str(tmp_path / "x.bson"), SCHEMA).count()
    with pytest.raises(Exception):
        BD.register(spark) or spark.read.format("bson_dump").option("path", str(tmp_path)).load()


def test_dump_stream_takes_new_files_once(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    docs = list(some_docs(90))

    def run():
        q = (BD.stream_dump(spark, str(src), "n long, name string", 500).writeStream.format("parquet")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
        q.awaitTermination()

    for i in range(3):
        (src / f"part-{i}.bson").write_bytes(b"".join(map(BD.encode, docs[30 * i: 30 * i + 30])))
        run()
        run()
        assert sorted(r.n for r in spark.read.parquet(out).collect()) == list(range(30 * i + 30))


def test_records_written_as_dump_read_back(spark, tmp_path):
    records = TB.records(spark, SF001)
    BD.write_dump(records, str(tmp_path / "d"))
    back = BD.scan_dump(spark, str(tmp_path / "d"), records.schema, 10_000)
    assert back.exceptAll(records).count() == 0 == records.exceptAll(back).count()


def test_bucketed_tables_join_and_group_without_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = B.image_documents(TB.table(spark, SF001, "embeddings"))
        a = SC.save_bucketed(docs, "bucketed_docs", "image_id", 4, path=str(tmp_path / "a"))
        b = SC.save_bucketed(docs.where("image_id % 2 = 0").select("image_id"), "bucketed_feats", "image_id", 4, path=str(tmp_path / "b"))
        marked = INC.mark_processed(SC.scan_catalog(spark, a), SC.scan_catalog(spark, b))
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert marked.where("processed").count() == docs.where("processed OR image_id % 2 = 0").count()
        rec = SC.save_bucketed(TB.records(spark, SF001), "bucketed_records", "sequence_id", 4, ["weather"], str(tmp_path / "r"))
        stats = M.sequence_stats(FR.to_frame_rows(SC.scan_catalog(spark, rec)))
        assert "Exchange" not in stats._jdf.queryExecution().executedPlan().toString()
        assert stats.exceptAll(M.sequence_stats(TB.frames(spark, SF001))).count() == 0
        known = SC.statistics(spark, rec)
        assert "200 rows" in known["Statistics"] and known["Num Buckets"] == "4"
        for value in ("Snowy", None):
            pruned = SC.scan_catalog(spark, rec, weather=value)
            plan = pruned._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [is" in plan and pruned.count() == TB.records(spark, SF001).where(F.col("weather").eqNullSafe(value)).count()
        assert {f.name for f in (tmp_path / "r").iterdir() if "weather=" in f.name} >= {"weather=Snowy"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("n", [0, 1, 4, 5, 997])
def test_split_by_hash_is_exact_and_ignores_partitioning(spark, n):
    rows = [(i if i else None, i % 3 if i % 10 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "sequence_id long, crash_severity int")
    want = set()
    for label in (0, 1, 2, None):
        own = sorted((hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), i is not None, i) for i, y in rows if y == label)
        want |= {i for _, _, i in own[: len(own) // 5]}
    for parts in (1, 7):
        train, test = ML.ml_split(df.repartition(parts))
        assert {r.sequence_id for r in test.collect()} == want and test.columns == df.columns
        assert train.count() + test.count() == n


def test_forest_as_table_scores_like_the_model(spark, tmp_path):
    rows = B.severity_training_rows(TB.records(spark, SF001))
    train, test = ML.ml_split(rows)
    model = ML.train_severity_model(train, num_trees=7)
    odd = spark.createDataFrame([(9001, None, "Hail", "Yes", 0), (9002, "Day", None, "?", 1)], test.schema)
    test = test.unionByName(odd)
    nodes = ML.forest_nodes(model, str(tmp_path / "forest"))
    scored = ML.score_with_nodes(test, nodes, ML.feature_codes(model), ML.forest_size(model))
    want = {r.sequence_id: r.prediction for r in ML.predict(model, test).collect()}
    assert {r.sequence_id: r.prediction for r in scored.collect()} == want
    # The same table scored in SQL alone.
    nodes.write.parquet(str(tmp_path / "nodes"))
    codes = ML.feature_codes(model)
    test.select("sequence_id", *codes).write.parquet(str(tmp_path / "test"))
    lists = {c: "[" + ",".join(f"'{x}'" for x in labels) + "]" for c, labels in codes.items()}
    xs = ", ".join(f"coalesce(nullif(list_position({v}, {c}), 0), {len(codes[c]) + 1}) - 1" for c, v in lists.items())
    sql = f"""
    WITH RECURSIVE n AS (SELECT * FROM '{tmp_path}/nodes/*.parquet'),
    t AS (SELECT sequence_id, [{xs}]::DOUBLE[] AS x FROM '{tmp_path}/test/*.parquet'),
    walk AS (
      SELECT t.sequence_id, t.x, n.* FROM t JOIN n ON n.node = 0
      UNION ALL
      SELECT w.sequence_id, w.x, n.* FROM walk w JOIN n ON n.tree = w.tree AND n.node = CASE
        WHEN coalesce(list_contains(w.left_categories, w.x[w.feature + 1]), w.x[w.feature + 1] <= w.threshold) THEN w."left" ELSE w."right" END
      WHERE w."left" >= 0),
    votes AS (SELECT sequence_id, generate_subscripts(votes, 1) - 1 AS c, unnest(votes) AS v FROM walk WHERE "left" < 0)
    SELECT sequence_id, arg_max(c, v) FROM (SELECT sequence_id, c, sum(v) - c * 1e-12 AS v FROM votes GROUP BY 1, 2) GROUP BY 1"""
    assert {i: float(c) for i, c in duckdb.sql(sql).fetchall()} == want


def test_types_that_do_not_fit_are_refused_or_null():
    assert BD.conform(2**40, T.IntegerType()) is None and BD.conform(1.5, T.LongType()) is None
    assert BD.conform(True, T.LongType()) is None and BD.conform(7, T.StringType()) == "7"
    with pytest.raises(ValueError):
        BD.conform(1, T.DateType())


def test_rows_of_equal_codes_are_scored_once(spark):
    """What goes down the trees does not grow with the rows."""
    from framewise.operators import model as ML
    nodes = spark.createDataFrame([(0, 0, 0, [0.0], None, 1, 2, [0.5, 0.5]), (0, 1, -1, None, None, -1, -1, [0.9, 0.1]),
                                   (0, 2, -1, None, None, -1, -1, [0.2, 0.8])],
                                  "tree int, node int, feature int, left_categories array<double>, threshold double, "
                                  "left int, right int, votes array<double>")
    rows = spark.range(50).selectExpr("id AS sequence_id", "CASE WHEN id % 2 = 1 THEN 'x' END AS c")
    scored = ML.score_with_nodes(rows, nodes, {"c": ["x"]}, (1, 1))
    assert {(r.sequence_id, r.prediction) for r in scored.collect()} == {(i, 0.0 if i % 2 else 1.0) for i in range(50)}
    plan = scored._jdf.queryExecution().optimizedPlan().toString().split("Generate ")
    exploded = [part for part in plan if part.startswith("explode")]
    assert exploded and all("Aggregate" in part for part in exploded)
