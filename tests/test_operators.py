"""Changes, JSON tables, delimited files, declared tables, plans and procedures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import dml, fulltext, relational
from sparkloom.operators.json_table import Field, json_table
from sparkloom.operators.model import Model
from sparkloom.plans.explain import access
from sparkloom.plans.named import Abort, Procedure, Registry, run_script
from sparkloom.sources import delimited, tables
from sparkloom.streaming import events


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_insert_ignore_and_replace(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, n int")
    s = spark.createDataFrame([(1, "z", 1), (3, "c", 2), (3, "d", 3), (4, "b", 4)], "id int, name string, n int")
    assert rows(dml.insert_ignore(t, s, [("id",), ("name",)], F.col("n"))) == [(1, "a", 10), (2, "b", 20), (3, "c", 2)]
    assert rows(dml.replace_into(t, s, [("id",), ("name",)], F.col("n"))) == [(1, "z", 1), (3, "d", 3), (4, "b", 4)]


def in_turn(target, source, keys, replace):
    """Rows (id, name, n) one after the other, as a database would take them."""
    out = list(target)
    for r in sorted(source, key=lambda r: r[2]):
        equal = [o for o in out if any(r[k] is not None and o[k] == r[k] for k in keys)]
        if replace:
            out = [o for o in out if o not in equal]
        if replace or not equal:
            out.append(r)
    return sorted(out, key=str)


def test_several_unique_keys(spark):
    schema = "id int, name string, n int"
    ignore = lambda t, s: rows(dml.insert_ignore(spark.createDataFrame(t, schema), spark.createDataFrame(s, schema), [("id",), ("name",)], F.col("n")))
    assert ignore([(9, "a", 0)], [(1, "a", 1), (1, "c", 2)]) == [(1, "c", 2), (9, "a", 0)]
    assert ignore([], [(1, "a", 1), (2, "a", 2), (2, "b", 3)]) == [(1, "a", 1), (2, "b", 3)]
    rng = random.Random(1)
    for _ in range(4):
        batch = [(rng.choice([None, *range(8)]), rng.choice([None, *"abcdefgh"]), n) for n in range(40)]
        t, s = in_turn([], batch[:10], (0, 1), False), batch[10:]
        assert ignore(t, s) == in_turn(t, s, (0, 1), False)
        got = dml.replace_into(spark.createDataFrame(t, schema), spark.createDataFrame(s, schema), [("id",), ("name",)], F.col("n"))
        assert rows(got) == in_turn(t, s, (0, 1), True)


def test_null_keys_never_conflict(spark):
    t = spark.createDataFrame([(None, 1)], "id int, n int")
    s = spark.createDataFrame([(None, 2), (None, 3)], "id int, n int")
    assert len(rows(dml.insert_ignore(t, s, [("id",)], F.col("n")))) == 3


def test_upsert_update_delete(spark):
    t = spark.createDataFrame([(1, 10), (2, None)], "id int, n int")
    s = spark.createDataFrame([(2, 5), (3, 7)], "id int, n int")
    assert rows(dml.upsert(t, s, ("id",))) == [(1, 10), (2, None), (3, 7)]
    assert rows(dml.upsert(t, s, ("id",), {"n": F.col("new.n") * 2})) == [(1, 10), (2, 10), (3, 7)]
    assert rows(dml.update(t, {"id": F.col("n"), "n": F.col("id")}, F.col("n") > 0)) == [(10, 1), (2, None)]
    assert rows(dml.delete(t, F.col("n") > 0)) == [(2, None)]
    assert rows(dml.delete(t)) == []
    assert rows(dml.affected(t, s, ("id",))) == [(1, 1, 3)]


def test_not_in_with_nulls(spark):
    a = spark.createDataFrame([(1,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "y int")
    assert rows(relational.not_in(a, "x", b, "y")) == []
    assert rows(relational.not_in(a, "x", b.dropna(), "y")) == [(1,)]
    assert len(rows(relational.not_in(a, "x", b.limit(0), "y"))) == 2


def test_json_table_errors(spark):
    d = spark.createDataFrame([(1, '[{"a":"x"},{"a":"5"}]'), (2, None), (3, "{oops")], "id int, doc string")
    assert rows(json_table(d, "doc", "$[*]", [Field("a", "int", "$.a"), Field("n", ordinality=True)]).drop("doc")) == [(1, 5, 2), (1, None, 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        json_table(d, "doc", "$[*]", [Field("a", "int", "$.a", on_error="error")]).collect()


def test_merge_without_a_column(spark):
    t = spark.createDataFrame([(1, "a", 10)], "id int, name string, n int")
    s = spark.createDataFrame([(1, 5), (2, 6)], "id int, n int")
    assert rows(dml.merge(t, s, ("id",), {"n": F.col("new.n")})) == [(1, "a", 5), (2, None, 6)]


def test_returning_by_key(spark):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, name string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, None)], "id int, name string")
    assert rows(dml.returning(before, after, ("id",))) == [(2, "b"), (3, None), (4, None)]


def test_fulltext_terms(spark):
    texts = ["Apache license", "the apache_license x", None, "", "APACHE, license!", "é apaché", "apache license apache"]
    d = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    hits = lambda q: [r.id for r in fulltext.match(d, "id", ["text"], q, fulltext.BOOLEAN).orderBy("id").collect()]
    assert hits("+apache") == [0, 4, 6]
    assert hits("apach*") == [0, 1, 4, 5, 6]
    assert hits('+"apache license"') == [0, 4, 6] and hits('+"license apache"') == [6]
    assert hits("+apache -license") == [] and hits("+a*b") == []
    found = {r.id: r.relevance for r in fulltext.natural(d, "id", F.col("text"), "apache").collect()}
    one = math.log(8 / 3.5)
    assert found == {0: round(one, 6), 4: round(one, 6), 6: round(2 * one, 6)}
    assert fulltext.natural(d, "id", F.col("text"), " ,").count() == 0


def test_skipped_lines_of_a_split_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("head\nhead\n" + "".join(f"{i}\tx\n" for i in range(2000)))
    (tmp_path / "b.txt").write_text("head\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = delimited.read_delimited(spark, str(tmp_path), "id int, t string", delimited.Options(ignore_lines=2))
        assert [r[0] for r in got.orderBy("id").collect()] == list(range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stream_batches(spark, tmp_path):
    """Two files in two batches: rows changed by both count once, with the later values."""
    for i, rows_ in enumerate(([("2024-01-01 00:10:00", "a", 1.0)], [("2024-01-01 00:20:00", "a", 2.0), ("2024-01-01 03:00:00", "b", 4.0)])):
        df = spark.createDataFrame(rows_, "ts string, event_type string, value double").selectExpr("CAST(ts AS TIMESTAMP) AS ts", "event_type", "value")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = events.latest_available(events.tumbling(stream), ["start", "event_type"])
    assert sorted((r.event_type, r.n, r.total) for r in out.collect()) == [("a", 2, 3.0), ("b", 1, 4.0)]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.txt").write_text('junk\nmore\nx>>1|"a|b"\nx>>2|\\N\nskipped\n')
    o = delimited.Options(terminated_by="|", enclosed_by='"', starting_by=">>", ignore_lines=2)
    assert rows(delimited.read_delimited(spark, str(tmp_path), "id int, t string", o)) == [(1, "a|b"), (2, None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b/b.txt").write_text("1\ta\n2\tb\n")
    assert rows(delimited.read_delimited(spark, str(tmp_path / "b"), "id int, t string, extra int")) == [(1, "a", None), (2, "b", None)]


def test_table_definition(spark):
    t = tables.Table("t", spark.createDataFrame([], "a int, b string").schema, ("a",), defaults={"b": "'x'"}, comment="it's")
    changed = t.add_column("c", "double", first=True).change_column("a", "z", "bigint", after="b")
    assert changed.schema.names == ["c", "b", "z"]
    assert "it\\'s" in t.ddl()
    assert t.default_row(spark).first().b == "x"


def test_model(spark):
    m = Model(spark.createDataFrame([(1, None), (2, "2020-01-01")], "id int, gone string"), "id", "gone")
    assert m.query().count() == 1 and m.find_one(2) is None and m.query().where("id = ?", [1]).exists()


def test_plan_reads_little(spark, sf):
    df = tables.load(spark, sf, "lineitem").where("l_quantity > 49").groupBy("l_returnflag").count()
    a = access(df)
    assert any("GreaterThan(l_quantity,49.0)" in p for p in a.pushed)
    assert set(a.columns[0]) == {"l_quantity", "l_returnflag"} and a.exchanges == 1


def test_small_side_is_broadcast(spark, sf):
    df = tables.load(spark, sf, "customer").join(tables.load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    assert access(df).joins == ["BroadcastHashJoin"]


def test_named_and_procedures(spark):
    r = Registry()

    @r.query("SELECT 1 AS x")
    def numbers(spark, sf_dir, n=3):
        """Numbers."""
        return spark.range(n)

    assert r.run("numbers", spark, "", n=5).count() == 5 and "Numbers." in r.describe("numbers") and "Range" in r.dry_run("numbers", spark, "")
    p = Procedure(spark)
    p.bind("proc_numbers", spark.range(4))
    assert p.scalar(spark.sql("SELECT count(*) FROM proc_numbers")) == 4
    assert p.parallel(lambda: 1, lambda: spark.range(2).count()) == [1, 2]
    with pytest.raises(Abort):
        p.abort_if(True, "enough")
    assert len(run_script(spark, "SELECT 1 AS a;\nSELECT 2 AS b;\n")) == 2
