from pyspark.sql import functions as F

from lanekit.functions import columns as C


def one(spark, expr, value=None, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_strip_tokens_in_order(spark):
    toks = C.SITE_SUFFIX_TOKENS
    assert one(spark, C.strip_tokens("s"), "杭州" + toks[0]) == "杭州"
    assert one(spark, C.strip_tokens("s"), "杭州" + toks[2] + toks[3]) == "杭州"
    assert one(spark, C.strip_tokens("s"), "杭州") == "杭州"
    assert one(spark, C.strip_tokens("s"), None) is None
    # literal, not regex
    assert one(spark, C.strip_tokens("s", ("a.c",)), "abc-a.c") == "abc-"


def test_split_at_literal_and_past_end(spark):
    assert one(spark, C.split_at("s", "*", 1), "a*b*c") == "b"
    assert one(spark, C.split_at("s", "*", 5), "a*b*c") is None
    assert one(spark, C.split_at("s", "-", 0), "x-y") == "x"
    assert one(spark, C.split_at("s", ".", 1), "a.b") == "b"


def test_safe_ratio_and_prorated(spark):
    df = spark.createDataFrame([(10.0, 0, 3), (10.0, None, 3), (10.0, 4, 2), (None, 4, 2)],
                               "w double, p int, q int")
    got = [r[0] for r in df.select(C.prorated("w", "p", "q")).collect()]
    assert got == [None, None, 5.0, 0.0]
    assert one(spark, C.safe_ratio(F.lit(1.0), F.lit(0)), None, "s int") is None


def test_route_segments(spark):
    rows = spark.createDataFrame([("X-Y-Z",), ("X-Y-X-Y",), ("X",), (None,), ("",)], "s string") \
        .select(C.route_segments("s").alias("r")).collect()
    assert rows[0]["r"] == ["A-B-C*X-Y*1.0*1", "A-B-C*Y-Z*1.0*2"]
    assert rows[1]["r"] == ["A-B-A-B*X-Y*1.0*1", "A-B-A-B*Y-X*1.0*2", "A-B-A-B*X-Y*1.0*3"]
    assert rows[2]["r"] == [] and rows[4]["r"] == []
    assert rows[3]["r"] is None
    r = one(spark, C.route_segments("s", 0.5, base=0), "P-Q")
    assert r == ["A-B*P-Q*0.5*0"]


def test_segment_fields(spark):
    f = C.segment_fields(F.col("s"))
    row = spark.createDataFrame([("A-B*X-Y*1.0*2",), ("A-B*X-Y",)], "s string") \
        .select(*[v.alias(k) for k, v in f.items()]).collect()
    assert tuple(row[0]) == ("A-B", "X-Y", "1.0", "2")
    assert tuple(row[1]) == ("A-B", "X-Y", None, None)


def test_rewrite_text_applies_each_rule_once_in_order(spark):
    rules = [("db", "db_new"), ("tbl", "t2")]
    assert one(spark, C.rewrite_text("s", rules), "db.tbl") == "db_new.t2"
    # a rule is applied once: no db_new_new
    assert one(spark, C.rewrite_text("s", [("db", "db_new")]), "db") == "db_new"


def test_line_helpers(spark):
    assert one(spark, C.first_token("s"), "  `Name` STRING ") == "`Name`"
    assert one(spark, C.clean_line("s"), "  `Name` 'STRING' ") == "name string"
    assert one(spark, C.first_token("s"), "") == ""
    assert one(spark, C.first_token("s"), "\t\x00foo bar\r") == "foo"
    assert one(spark, C.clean_line("s"), "\r\tFoo 'Bar'\t\r ") == "foo bar"
    assert one(spark, C.clean_line("s"), "\u00a0x") == "\u00a0x"


def test_stop_pattern_names_stay_apart(spark):
    names = one(spark, C.stop_pattern(F.transform(F.sequence(F.lit(1), F.lit(600)), lambda i: i.cast("string")))).split("-")
    assert names[:2] == ["A", "B"] and names[25:28] == ["Z", "A1", "B1"] and len(set(names)) == 600
    assert one(spark, C.stop_pattern(F.array(*map(F.lit, "XYXY")))) == "A-B-A-B"
