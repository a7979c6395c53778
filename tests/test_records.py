from pyspark.sql import functions as F

from visitlab.functions import packed as P
from visitlab.functions import text as X
from visitlab.functions import time as D


def _one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("out")).collect()]


def test_packed_field_rules(spark):
    text = "a=1|b=|c=x=y|a=2|=v"
    df = spark.createDataFrame([(text,)], "s string")
    r = df.select(P.packed_field("s", "a").alias("a"), P.packed_field("s", "b").alias("b"),
                  P.packed_field("s", "c").alias("c"), P.packed_field("s", "z").alias("z"),
                  P.packed_field("s", "").alias("empty_key")).collect()[0]
    assert (r["a"], r["b"], r["c"], r["z"], r["empty_key"]) == ("1", None, None, None, "v")


def test_set_packed_field_keeps_order_and_empty_values(spark):
    df = spark.createDataFrame([("a=1|b=|c=3",)], "s string")
    r = df.select(P.set_packed_field("s", "a", "'9'").alias("first"),
                  P.set_packed_field("s", "c", "'x'").alias("last"),
                  P.set_packed_field("s", "q", "'x'").alias("absent"),
                  P.set_packed_field("s", "b", "NULL").alias("null_value")).collect()[0]
    assert r["first"] == "a=9|b=|c=3"
    assert r["last"] == "a=1|b=|c=x"
    assert r["absent"] == "a=1|b=|c=3"
    assert r["null_value"] == "a=1|b=|c=3"


def test_pack_round_trip(spark):
    df = spark.createDataFrame([("s1", None, 5)], "sid string, kw string, n bigint")
    packed = df.select(P.pack([("sessionid", "sid"), ("searchKeywords", "kw"),
                               ("visitLength", "n")]).alias("p"))
    r = packed.select("p", P.packed_field("p", "searchKeywords").alias("kw"),
                      P.packed_field("p", "visitLength").alias("n")).collect()[0]
    assert r["p"] == "sessionid=s1|searchKeywords=|visitLength=5"
    assert r["kw"] is None and r["n"] == "5"


def test_trim_comma_and_emptiness(spark):
    vals = [",a", "a,", ",a,", ",", "", None]
    out = _one(spark, [(v,) for v in vals], "s string", X.trim_comma("s"))
    assert out == ["a", "a", "a", "", "", None]
    empty = _one(spark, [(v,) for v in vals], "s string", X.is_empty("s"))
    assert empty == [False, False, False, False, True, True]
    not_empty = _one(spark, [(v,) for v in vals], "s string", X.is_not_empty("s"))
    assert not_empty == [True, True, True, True, False, False]


def test_fill_two_digits_is_not_lpad(spark):
    out = _one(spark, [("",), ("7",), ("12",), ("123",)], "s string", X.fill_two_digits("s"))
    assert out == ["0", "07", "12", "0123"]


def test_split_ids(spark):
    out = _one(spark, [("5,5",), ("5, 6",), ("x,7,",), (None,)], "s string", X.split_ids("s"))
    assert out == [[5, 5], [5, 6], [7], None]


def test_time_helpers(spark):
    df = spark.createDataFrame([("2024-01-05 3:04:05",), ("bad",)], "t string")
    ts = D.parse_time_sql("t")
    r = df.select(D.format_time(ts).alias("f"), D.date_key(ts).alias("k"),
                  D.minute_key(ts).alias("m"), D.date_hour("t").alias("dh")).collect()
    assert tuple(r[0]) == ("2024-01-05 03:04:05", "20240105", "202401050304", "2024-01-05_3")
    assert r[1]["f"] is None
    r2 = spark.range(1).select(
        D.seconds_between("TIMESTAMP'2024-01-01 00:01:00'", "TIMESTAMP'2024-01-01 00:00:00'").alias("s"),
        D.is_before("TIMESTAMP'2024-01-01 00:00:00'", "TIMESTAMP'2024-01-02 00:00:00'").alias("b"),
        F.expr(f"CAST({D.parse_date_key_sql(chr(39) + '20240229' + chr(39))} AS STRING)").alias("d"),
        D.yesterday("2024-03-01").cast("string").alias("y")).collect()[0]
    assert (r2["s"], r2["b"], r2["d"], r2["y"]) == (60, True, "2024-02-29", "2024-02-29")


def test_ratio_half_up_exact(spark):
    rows = [(c, n) for n in range(1, 60) for c in range(0, n + 1)]
    df = spark.createDataFrame(rows, "c bigint, n bigint")
    got = df.select("c", "n", X.ratio_half_up("c", "n").alias("r")).collect()
    for r in got:
        expected = ((200 * r["c"] + r["n"]) // (2 * r["n"])) / 100
        assert r["r"] == expected


def test_product_status(spark):
    from visitlab.operators.records import product_status
    df = spark.createDataFrame(
        [(1, "a", '{"product_status": 1}'), (2, "b", "{}"), (3, "c", '{"product_status": "x"}')],
        "product_id bigint, product_name string, extend_info string")
    assert [r["product_status"] for r in product_status(df).orderBy("product_id").collect()] == [1, None, None]


def test_a_delimiter_of_several_characters_is_refused():
    import pytest

    from visitlab.functions.packed import packed_field_sql
    with pytest.raises(ValueError):
        packed_field_sql("t", "k", "||")


def test_packed_entries_follow_the_same_rules(spark):
    """One scan reads what the anchored pattern of each key reads."""
    from pyspark.sql import functions as F

    texts = ["a=1|b=2", "a=|a=2|a=3", "a=b|b=c|c=a", "b=1=2|b=3", "=x|a=1", "a", "", None, "|a=1||b=2|", "ab=1|a=2", "a=1|b",
             "x=a|a=|b=a", "a=1\n|b=2", "k=v=|k=w", "a = 1|a=2"]
    df = spark.createDataFrame([(t,) for t in texts], "s string").withColumn("e", F.expr(P.packed_entries_sql("s")))
    for key in ("a", "b", "c", "k", "ab", "x", "q"):
        for r in df.select("s", F.expr(P.entry_value_sql("e", key)).alias("got"), P.packed_field("s", key).alias("want")).collect():
            assert r["got"] == r["want"], (key, r)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_packed_profile_fields_scans_the_record_once(spark):
    from visitlab.plans.queries import REGISTRY
    from visitlog_rows import SF_SMALL
    plan = REGISTRY["packed_profile_fields"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
