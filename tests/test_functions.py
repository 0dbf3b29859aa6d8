import datetime

import pytest
from pyspark.sql import functions as F

from clickloom.functions import predicates as P
from clickloom.functions import text, times
from clickloom.functions.sql import register_sql_functions
from clickloom.params import TaskParams
from tests.conftest import rows


def one(spark, *columns, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return tuple(df.select(*columns).first())


def test_times_take_unpadded_hours(spark):
    a, b = F.lit("2018-10-09 9:05:03"), F.lit("2018-10-09 10:00:00")
    assert one(spark, times.before(a, b), times.after(a, b), times.minus(b, a)) == (True, False, 3297)
    assert one(spark, times.date_hour(a), times.format_date(a), times.format_time(a)) == (
        "2018-10-09_09", "2018-10-09", "2018-10-09 09:05:03",
    )
    assert one(spark, times.format_date_key(a), times.format_minute(a)) == ("20181009", "201810090905")


def test_time_of_garbage_is_null(spark):
    assert one(spark, times.parse_time(F.lit("soon"))) == (None,)


def test_date_key_and_minute_key(spark):
    assert one(spark, times.parse_date_key(F.lit("20240229"))) == (datetime.date(2024, 2, 29),)
    assert one(spark, *times.minute_key_parts(F.lit("202401020304"))) == ("2024-01-02", "03", "04")


def test_today_and_yesterday(spark):
    today, yesterday, expected = one(
        spark, times.today(), times.yesterday(), F.current_date().alias("d")
    )
    assert today == expected.isoformat()
    assert yesterday == (expected - datetime.timedelta(days=1)).isoformat()


@pytest.mark.parametrize(
    "value, scale, expected",
    [(0.285, 2, 0.29), (0.125, 2, 0.13), (-0.125, 2, -0.13), (1.005, 2, 1.01), (2.5, 0, 3.0)],
)
def test_round_half_up(spark, value, scale, expected):
    assert one(spark, text.round_half_up(F.lit(value), scale)) == (expected,)


@pytest.mark.parametrize(
    "value, expected", [("a,b", "a,b"), (",a", "a"), ("a,", "a"), (",a,", "a"), (",,", ""), ("", "")]
)
def test_trim_comma(spark, value, expected):
    assert one(spark, text.trim_comma(F.lit(value))) == (expected,)


@pytest.mark.parametrize("value, expected", [("7", "07"), ("12", "12"), ("123", "0123"), ("", "0")])
def test_pad_two(spark, value, expected):
    assert one(spark, text.pad_two(F.lit(value))) == (expected,)


def test_empty(spark):
    null = F.lit(None).cast("string")
    assert one(
        spark, text.is_empty(null), text.is_empty(F.lit("")), text.is_not_empty(F.lit("x"))
    ) == (True, True, True)


@pytest.mark.parametrize(
    "record, field, expected",
    [
        ("a=1|b=2", "b", "2"),
        ("a=1|b=2", "c", None),
        ("a=|b=2", "a", None),
        ("xa=1|a=2", "a", "2"),
        ("a=1|a=2", "a", "1"),
        ("a=1=2|b=3", "a", None),
        ("a.c=1", "abc", None),
        ("k=x,y z|n=1", "k", "x,y z"),
        (None, "a", None),
    ],
)
def test_kv_get(spark, record, field, expected):
    assert one(spark, text.kv_get(F.lit(record).cast("string"), field)) == (expected,)


def test_kv_get_with_a_long_delimiter(spark):
    assert one(spark, text.kv_get(F.lit("a=x:y::b=2"), "a", "::")) == ("x:y",)
    assert one(spark, text.kv_get(F.lit("a=x:y::b=2"), "b", "::")) == ("2",)


@pytest.mark.parametrize(
    "record, expected", [("a=1|b=2", "a=9|b=2"), ("b=2", "b=2"), ("ab=1|a=", "ab=1|a=9")]
)
def test_kv_set(spark, record, expected):
    assert one(spark, text.kv_set(F.lit(record), "a", "9")) == (expected,)


@pytest.mark.parametrize(
    "value, expected", [("1,2", [1, 2]), ("5,5", [5, 5]), ("", []), ("1,x, 3", [1, 3]), (None, None)]
)
def test_id_list(spark, value, expected):
    assert one(spark, text.id_list(F.lit(value).cast("string"))) == (expected,)


def test_json_field(spark):
    get = lambda doc: one(spark, text.json_field(F.lit(doc).cast("string"), "product_status"))[0]
    assert get('{"product_status": 0}') == "0"
    assert get('{"other": 0}') is None
    assert get("{broken") is None
    dotted = text.json_field(F.lit('{"a.b": 1, "a": {"b": 2}, "c[0]": 3}'), "a.b")
    assert one(spark, dotted) == ("1",)
    assert get(None) is None


def test_group_concat_distinct_keeps_values_inside_others(spark):
    df = spark.createDataFrame(
        [(1, "11:NATION_11"), (1, "1:NATION_1"), (1, "1:NATION_1"), (1, None), (2, None)],
        "g int, x string",
    )
    got = rows(df.groupBy("g").agg(text.group_concat_distinct("x").alias("x")))
    assert got == [(1, "11:NATION_11,1:NATION_1"), (2, None)]


def test_sql_functions(spark):
    register_sql_functions(spark)
    got = spark.sql(
        """SELECT concat_long_string(1, 'a', ':') AS a, get_json_field('{"f.g": 3}', 'f.g') AS f,
                  concat_distinct(collect_list(x)) AS g
           FROM VALUES ('b'), ('a'), ('b'), (null) AS t(x)"""
    ).first()
    assert tuple(got) == ("1:a", "3", "a,b")


@pytest.mark.parametrize(
    "test, expected",
    [
        (lambda: P.in_range(F.lit(20), 20, 50), True),
        (lambda: P.in_range(F.lit(50), 20, 50), True),
        (lambda: P.in_range(F.lit(51), 20, 50), False),
        (lambda: P.in_range(F.lit(51), 20, None), True),
        (lambda: P.in_range(F.lit(None).cast("int"), 20, 50), False),
        (lambda: P.any_of(F.lit("2,15"), "15,16"), True),
        (lambda: P.any_of(F.lit("2,15"), "5"), False),
        (lambda: P.any_of(F.lit("2,15"), ""), True),
        (lambda: P.any_of(F.lit("-1"), "-1"), False),
        (lambda: P.any_of(F.lit(None).cast("string"), "1"), False),
        (lambda: P.one_of(F.lit("新辣道鱼火锅"), "火锅"), False),
        (lambda: P.one_of(F.lit("火锅"), "蛋糕,火锅"), True),
        (lambda: P.one_of(F.lit(None).cast("string"), "a"), False),
        (lambda: P.equals(F.lit("male"), "male"), True),
        (lambda: P.equals(F.lit("male"), None), True),
        (lambda: P.equals(F.lit(None).cast("string"), "male"), False),
    ],
)
def test_predicates(spark, test, expected):
    assert one(spark, test()) == (expected,)


def test_params_from_json():
    text_ = '{"startAge": "20", "endAge": 50, "sex": "", "targetPageFlow": "1,2", "other": 1}'
    params = TaskParams.from_json(text_)
    assert (params.start_age, params.end_age, params.sex) == (20, 50, None)
    assert params.target_page_flow == "1,2"
