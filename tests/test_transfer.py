import datetime as dt
import decimal

import pytest
from pyspark.sql import types as T

from lanekit.sources import transfer as X
from lanekit.sources.scratch import scratch_path

ALL_TYPES = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("l", T.LongType()),
    T.StructField("f", T.FloatType()), T.StructField("d", T.DoubleType()),
    T.StructField("dec", T.DecimalType(10, 2)), T.StructField("b", T.BooleanType()),
    T.StructField("day", T.DateType()), T.StructField("ts", T.TimestampType()),
    T.StructField("bin", T.BinaryType()), T.StructField("arr", T.ArrayType(T.IntegerType())),
    T.StructField("m", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("st", T.StructType([T.StructField("a", T.IntegerType()), T.StructField("z", T.StringType())])),
    T.StructField("all_null", T.StringType()),
    T.StructField("dt", T.StringType()), T.StructField("region", T.StringType()),
])


def _rows():
    full = (1, 10 ** 12, 1.5, 2.25, decimal.Decimal("12.34"), True, dt.date(2022, 1, 23),
            dt.datetime(2022, 1, 23, 12, 0, 0), b"\x00\xff", [1, 2], {"k": 1.0}, (7, "z"), None,
            "20220123", "east")
    rows = [full]
    for i in range(13):           # one null in each non-partition column
        r = list(full)
        r[i] = None
        r[13] = "20220124"
        rows.append(tuple(r))
    return rows


def _same(a, b):
    key = lambda r: repr(tuple(r))
    return sorted(a, key=key) == sorted(b, key=key)


def test_export_restore_roundtrip_every_type(spark):
    df = spark.createDataFrame(_rows(), ALL_TYPES)
    db = X.scratch_database(spark, "t_rt")
    X.save_table(df, f"{db}.src", partition_cols=["dt", "region"])
    out = scratch_path(spark, "t_export")
    src = X.export_table(spark, f"{db}.src", out, codec="gzip")
    d = X.read_definition(spark, src)
    assert d.partition_cols == ("dt", "region")
    table = X.restore_table(spark, src, target=f"{db}.restored")
    back = spark.table(table)
    assert back.schema == spark.table(f"{db}.src").schema     # exact types, order and partitions
    assert _same(back.collect(), spark.table(f"{db}.src").collect())
    assert "all_null" in back.columns


def test_inferred_read_widens_types(spark):
    df = spark.createDataFrame([(1, decimal.Decimal("1.50"), None)], "i int, dec decimal(5,2), n string")
    out = scratch_path(spark, "t_infer")
    src = X.export_table(spark, df, out, name="t")
    inferred = X.read_json_inferred(spark, f"{src}/json")
    types = dict((f.name, f.dataType.simpleString()) for f in inferred.schema.fields)
    assert types["i"] == "bigint" and types["dec"] == "double"


def test_export_conditions_then_limit_and_codec_check(spark):
    df = spark.range(100).withColumnRenamed("id", "x")
    out = scratch_path(spark, "t_lim")
    src = X.export_table(spark, df, out, name="t", conditions={"where": ["x >= 50"]}, order_by=["x"], limit=5)
    assert [r[0] for r in X.read_export(spark, src).orderBy("x").collect()] == [50, 51, 52, 53, 54]
    with pytest.raises(ValueError):
        X.export_table(spark, df, out, name="t", codec="lzo")
    # replace: exporting again overwrites the directory
    X.export_table(spark, df.limit(3), out, name="t")
    assert X.read_export(spark, src).count() == 3


def test_restore_with_rename_rules_applied_once(spark):
    db = X.scratch_database(spark, "t_src")
    X.save_table(spark.range(4), f"{db}.things")
    out = scratch_path(spark, "t_ren")
    src = X.export_table(spark, f"{db}.things", out)
    new_db = X.scratch_database(spark, "t_dst")
    name = X.restore_table(spark, src, rename_rules=[(db, new_db), (".things", ".items")])
    assert name == f"{new_db}.items"
    assert spark.table(name).count() == 4


def test_month_derivation_on_restore(spark):
    df = spark.createDataFrame([(1, "20220123", "199901")], "v int, dt string, month string")
    out = scratch_path(spark, "t_month")
    db = X.scratch_database(spark, "t_m")
    src = X.export_table(spark, df, out, name=f"{db}.m")
    name = X.restore_table(spark, src, month_from="dt")
    assert spark.table(name).first()["month"] == "202201"


def test_clone_definition_is_idempotent_and_insert_is_by_name(spark):
    db = X.scratch_database(spark, "t_clone")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                           T.StructField("p", T.StringType())])
    assert X.clone_definition(spark, schema, f"{db}.c", partition_cols=["p"])
    assert not X.clone_definition(spark, schema, f"{db}.c", partition_cols=["p"])
    X.insert_rows(spark, spark.createDataFrame([("x", "p1", 1)], "b string, p string, a int"), f"{db}.c")
    assert tuple(spark.table(f"{db}.c").first()) == (1, "x", "p1")


def test_publish_appends_orc_partitions(spark):
    db = X.scratch_database(spark, "t_pub")
    df = spark.createDataFrame([(1,)], "v int")
    X.publish(df.selectExpr("v", "20220123 AS dt"), f"{db}.mart")
    X.publish(df.selectExpr("v", "20220124 AS dt"), f"{db}.mart")
    X.publish(df.selectExpr("v", "20220124 AS dt"), f"{db}.mart")
    got = sorted(tuple(r) for r in spark.table(f"{db}.mart").collect())
    assert got == [(1, 20220123), (1, 20220124), (1, 20220124)]
    assert X.partition_columns(spark, f"{db}.mart") == ("dt",)
    assert "orc" in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.mart").where("col_name = 'Provider'").first()[1]


def test_dynamic_overwrite_replaces_touched_partitions_only(spark):
    db = X.scratch_database(spark, "t_dyn")
    X.save_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), f"{db}.t", partition_cols=["p"])
    X.save_table(spark.createDataFrame([(3, "b")], "v int, p string"), f"{db}.t", partition_cols=["p"], dynamic=True)
    assert sorted(tuple(r) for r in spark.table(f"{db}.t").collect()) == [(1, "a"), (3, "b")]


def test_describe_and_catalog(spark):
    db = X.scratch_database(spark, "t_desc")
    X.save_table(spark.createDataFrame([(1, "x")], "a int, p string"), f"{db}.t", partition_cols=["p"])
    rows = X.describe_table(spark, f"{db}.t").collect()
    assert [(r.col_name, r.data_type, r.is_partition, r.row_count) for r in rows] == \
        [("a", "int", False, 1), ("p", "string", True, 1)]
    assert "t" in [r.name for r in X.list_tables(spark, db).collect()]


def test_under_split_export_writes_several_files(spark):
    import glob
    df = spark.range(0, 1000, numPartitions=1)
    out = scratch_path(spark, "t_files")
    src = X.export_table(spark, df, out, name="t", codec="gzip", min_files=4)
    files = glob.glob(src.replace("file:", "") + "/json/part-*")
    assert len(files) >= 4
    assert X.read_export(spark, src).count() == 1000


def test_transfer_errors_and_condition_order(spark):
    df = spark.range(20).withColumnRenamed("id", "x")
    with pytest.raises(ValueError):
        X.export_table(spark, df, scratch_path(spark, "t_err"))          # DataFrame needs a name
    with pytest.raises(Exception):
        X.read_definition(spark, scratch_path(spark, "t_missing"))
    out = scratch_path(spark, "t_cond")
    # unknown clause names are applied after where/having, blank conditions are ignored
    src = X.export_table(spark, df, out, name="t",
                         conditions={"qualify": ["x % 2 = 0"], "where": ["x < 10", ""], "having": ["x > 3"]})
    assert sorted(r[0] for r in X.read_export(spark, src).collect()) == [4, 6, 8]


def test_export_all_and_restore_each(spark):
    out = scratch_path(spark, "t_all")
    db = X.scratch_database(spark, "t_all")
    dirs = X.export_all(spark, [("a", spark.range(3)), ("b", spark.range(5))], out)
    counts = {n: spark.table(X.restore_table(spark, d, target=f"{db}.{n}")).count() for n, d in dirs.items()}
    assert counts == {"a": 3, "b": 5}


def test_timestamps_keep_microseconds_and_maps_any_key(spark):
    schema = ("ts timestamp, n timestamp_ntz, m map<int, struct<a: date, b: map<bigint, string>>>, "
              "l array<map<date, double>>, s struct<m: map<timestamp, int>>, k map<string, map<int, int>>")
    ts = dt.datetime(2022, 1, 23, 12, 0, 0, 123456)
    rows = [(ts, ts, {1: (dt.date(2020, 1, 1), {2: "x", 3: None})}, [{dt.date(2020, 1, 2): 0.5}, None], ({ts: 1},),
             {"a": {1: 2}}), (None,) * 6, (ts, None, {}, [], (None,), {})]
    df = spark.createDataFrame(rows, schema)
    src = X.export_table(spark, df, scratch_path(spark, "t_types"), name="t")
    back = X.read_export(spark, src)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert _same(back.collect(), df.collect())


def test_damage_is_loud(spark):
    out, db = scratch_path(spark, "t_damage"), X.scratch_database(spark, "t_damage")
    src = X.export_table(spark, spark.range(20), out, name="t")
    assert X.read_definition(spark, src).row_count == 20
    spark.range(1).selectExpr("'{broken' AS value").write.mode("append").text(f"{src}/json")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        X.read_export(spark, src).collect()
    src = X.export_table(spark, spark.range(20), out, name="u")
    spark.range(5).write.mode("append").json(f"{src}/json")
    with pytest.raises(ValueError, match="20 rows were exported"):
        X.restore_table(spark, src, target=f"{db}.u")


def test_a_failed_export_leaves_no_definition(spark):
    out = scratch_path(spark, "t_failed")
    with pytest.raises(Exception):
        X.export_table(spark, spark.range(5).selectExpr("raise_error('no') AS x"), out, name="t")
    with pytest.raises(Exception):
        X.read_definition(spark, f"{out}/t")


def test_ordered_exports_stay_ordered(spark):
    df = spark.range(2000).selectExpr("id", "(id * 7919) % 2003 AS k")
    src = X.export_table(spark, df, scratch_path(spark, "t_order"), name="t", order_by=["k"], min_files=6)
    found = [[r["k"] for r in spark.read.json(f).collect()] for f in sorted(spark.read.json(f"{src}/json").inputFiles())]
    flat = [k for part in found for k in part]
    assert flat == sorted(flat) and len(flat) == 2000


def test_month_only_where_the_definition_has_it(spark):
    db, out = X.scratch_database(spark, "t_month"), scratch_path(spark, "t_month")
    src = X.export_table(spark, spark.createDataFrame([("20220123",)], "dt string"), out, name="a")
    assert spark.table(X.restore_table(spark, src, target=f"{db}.a", month_from="dt")).columns == ["dt"]
    src = X.export_table(spark, spark.createDataFrame([("20220123", "x")], "dt string, month string"), out, name="b")
    assert spark.table(X.restore_table(spark, src, target=f"{db}.b", month_from="dt")).first()["month"] == "202201"


def test_definition_carries_format_location_and_comment(spark):
    db, out = X.scratch_database(spark, "t_def"), scratch_path(spark, "t_def")
    X.save_table(spark.range(3), f"{db}.t", fmt="orc", location=scratch_path(spark, "old_host"))
    spark.sql(f"COMMENT ON TABLE {db}.t IS 'kept on old_host'")
    src = X.export_table(spark, f"{db}.t", out, name=f"{db}.t")
    rules = [("old_host", "new_host"), (".t", ".u")]
    d = X.read_definition(spark, src, rules)
    assert d.format == "orc" and "new_host" in d.location and d.comment == "kept on new_host" and d.table == f"{db}.u"
    name, created = X.create_from_export(spark, src, rename_rules=rules, keep_location=True)
    about = X.table_properties(spark, name)
    assert created and "new_host" in about["Location"] and about["Comment"] == "kept on new_host"
    assert X.restore_all(spark, [src], rename_rules=[(".t", ".v")]) == {f"{db}.t": f"{db}.v"}
    assert spark.table(f"{db}.v").count() == 3


def _damaged_export(spark, out, how):
    src = X.export_table(spark, spark.range(100).selectExpr("id", "id % 3 AS p"), out, name="t", min_files=1)
    if how == "line":
        spark.createDataFrame([('{"id": "no number", "p": 1}',)], "value string").coalesce(1).write.mode("append").text(f"{src}/json")
    else:
        spark.createDataFrame([('{"id": 7, "p": 1}',)], "value string").coalesce(1).write.mode("append").text(f"{src}/json")
    return src


@pytest.mark.parametrize("how", ["line", "count"])
def test_a_failed_restore_leaves_its_target_as_it_was(spark, how):
    db, out = X.scratch_database(spark, "t_keep"), scratch_path(spark, "t_keep")
    src = _damaged_export(spark, out, how)
    def old():
        return spark.range(7).selectExpr("id", "id + 0 AS p")
    X.save_table(old(), f"{db}.plain")
    X.save_table(old(), f"{db}.elsewhere", location=scratch_path(spark, "t_elsewhere"))
    for name, kw in (("plain", {}), ("plain", {"mode": "append"}), ("plain", {"dynamic": True}), ("elsewhere", {})):
        with pytest.raises(Exception):
            X.restore_table(spark, src, target=f"{db}.{name}", **kw)
        spark.catalog.refreshTable(f"{db}.{name}")
        assert sorted(r.id for r in spark.table(f"{db}.{name}").collect()) == list(range(7)), (name, kw)
    with pytest.raises(Exception):
        X.restore_table(spark, src, target=f"{db}.fresh")
    assert sorted(t.name for t in spark.catalog.listTables(db)) == ["elsewhere", "plain"]


def test_a_restore_replaces_and_adds_to_its_target(spark):
    db, out = X.scratch_database(spark, "t_swap"), scratch_path(spark, "t_swap")
    src = X.export_table(spark, spark.range(100).selectExpr("id", "id % 3 AS p"), out, name="t")
    X.save_table(spark.range(7).selectExpr("id", "'x' AS other"), f"{db}.t")
    X.restore_table(spark, src, target=f"{db}.t")
    assert spark.table(f"{db}.t").columns == ["id", "p"] and spark.table(f"{db}.t").count() == 100
    X.restore_table(spark, src, target=f"{db}.t", mode="append")
    assert spark.table(f"{db}.t").count() == 200
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]


def test_a_failed_export_removes_the_earlier_definition(spark):
    out = scratch_path(spark, "t_stale")
    X.export_table(spark, spark.range(5), out, name="t")
    with pytest.raises(Exception):
        X.export_table(spark, spark.range(5).selectExpr("raise_error('no') AS x"), out, name="t")
    with pytest.raises(Exception):
        X.read_definition(spark, f"{out}/t")


def test_a_batch_reports_a_failed_table(spark):
    db, out = X.scratch_database(spark, "t_batch"), scratch_path(spark, "t_batch")
    good = [(f"t{i}", spark.range(i + 1)) for i in range(6)]
    dirs = X.export_all(spark, good, out, jobs=3)
    assert list(dirs) == [n for n, _ in good]
    assert X.restore_all(spark, dirs, targets={n: f"{db}.{n}" for n in dirs}, jobs=3) == {n: f"{db}.{n}" for n in dirs}
    assert [spark.table(f"{db}.t{i}").count() for i in range(6)] == [1, 2, 3, 4, 5, 6]
    with pytest.raises(Exception, match="no luck"):
        X.export_all(spark, [*good, ("bad", spark.range(1).selectExpr("raise_error('no luck') AS x"))], out, jobs=2)


def test_preview_shows_text(spark):
    df = spark.sql("SELECT id, map('a', id) AS m, CAST(NULL AS DATE) AS d FROM range(50)")
    assert [tuple(r) for r in X.preview(spark, df, 2, ["id"]).collect()] == [("0", '{"a":0}', None), ("1", '{"a":1}', None)]


def test_a_batch_is_compressed_unless_told_otherwise(spark):
    out, df = scratch_path(spark, "t_batch_codec"), spark.range(2000).selectExpr("id", "'the same words' AS words")
    plain = X.export_all(spark, [("a", df)], f"{out}/plain", codec="none")
    packed = X.export_all(spark, [("a", df)], f"{out}/packed")
    assert all(f.endswith(".json") for f in spark.read.text(f"{plain['a']}/json").inputFiles())
    assert all(f.endswith(".json.gz") for f in spark.read.text(f"{packed['a']}/json").inputFiles())
    assert sorted(X.read_export(spark, packed["a"]).collect()) == sorted(df.collect())
