import pytest
from pyspark.sql import functions as F

from cefframe import cef_escape_extension, cef_escape_header, cef_extensions, cef_header, cef_timestamp, register_cef_functions
from cefframe.functions.values import MONTHS
from cefframe.plans.inspect import count_calls, optimized_plan
from lines import lines_df

TIMES = ["1655789415000", "-5", "0005", "+7", "99999999999999999999", "9223372036854775807", "Jun 21 2022 05:30:15",
         "Jun 21 2022 05:30:15.123 EST", "Jun 21 05:30:15", "Jun 21 05:30:15.123", "Jun 21 05:30:15 UTC", "Jun 21 2022 05:30:15 Z",
         "Jun 21 2022 05:30:15.9 UTC", "Feb 30 10:00:00", "Feb 30 2020 10:00:00.500", "Feb 31 2021 10:00:00 GMT", "Apr 31 2020 10:00:00 CET",
         "Jan 32 2020 10:00:00", "Xxx 01 2020 00:00:00", "Aug 13 2020 10:01:46 +02:00", "Aug 13 2020 25:01:46", "2022-06-21T05:30:15Z",
         "2022-06-21t05:30+02:00", "2022-06-21T05:30:15.123456789[Europe/Paris]", "2022-06-21T05:30:15", "2022-13-21T05:30:15Z",
         "2022-06-21 05:30:15", "bad", "", " ", None] + [f"{m} 09 2021 01:02:03.004 PST" for m in MONTHS]
LINES = ["CEF:0|V\\|x|P|1|s|n|1|eventId=1 cs1= a  cs1Label=Si\\\\te badge=7 badge=- x=y\\=z", "CEF:0|V|P", "", None, "a\\=b|c\\|d\r\ne\nf\rg\\",
         "CEF:0|V|P|1|s|n|1|a=1 b=2", "CEF:0|V|P|1|s|n|1|", "CEF:0|V|P|1|s|n|1|a=1\u001f b=\u0001-\u0002 c='q\"uote'", "|||||||k=v"]


@pytest.fixture(scope="module")
def registered(spark):
    register_cef_functions(spark)
    register_cef_functions(spark)  # once more: they are replaced
    return spark


def test_timestamps_equal_the_column_function(registered):
    df = lines_df(registered, TIMES)
    rows = df.select("value", F.expr("cef_timestamp(value)").alias("a"), cef_timestamp(F.col("value")).alias("b")).collect()
    assert [r.value for r in rows if r.a != r.b] == []
    assert sum(r.a is not None for r in rows) > 25


def test_lines_equal_the_column_functions(registered):
    df = lines_df(registered, LINES)
    pairs = {"cef_header": cef_header, "cef_extensions": cef_extensions, "cef_escape_header": cef_escape_header,
             "cef_escape_extension": cef_escape_extension}
    for name, function in pairs.items():
        rows = df.select("value", F.expr(f"{name}(value)").alias("a"), function(F.col("value")).alias("b")).collect()
        assert [r.value for r in rows if r.a != r.b] == [], name


def test_sql_text(registered):
    lines_df(registered, LINES).createOrReplaceTempView("cef_raw_lines")
    rows = registered.sql("""SELECT cef_header(value).Severity AS sev, cef_extensions(value)['a'] AS a FROM cef_raw_lines
                             WHERE cef_extensions(value)['b'] = '2'""").collect()
    assert [(r.sev, r.a) for r in rows] == [("1", "1")]
    grouped = registered.sql("SELECT cef_header(value).Name AS n, count(*) AS c FROM cef_raw_lines GROUP BY 1 ORDER BY 2 DESC").collect()
    assert sum(r.c for r in grouped) == len(LINES)


def test_functions_are_inlined(registered):
    lines_df(registered, LINES).createOrReplaceTempView("cef_raw_lines")
    plan = optimized_plan(registered.sql("SELECT cef_extensions(value)['a'], cef_header(value).Name FROM cef_raw_lines"))
    assert count_calls(plan, "regexp_extract_all") == 1 and "cef_pairs(" not in plan.replace("AS cef_", "")
    assert "regexp_extract_all" not in optimized_plan(registered.sql("SELECT cef_header(value).Name AS n FROM cef_raw_lines"))


def test_a_filter_on_a_call_computes_its_pairs_once(registered):
    lines_df(registered, LINES).createOrReplaceTempView("cef_raw_lines")
    df = registered.sql("""SELECT cef_extensions(value)['a'] AS a FROM (SELECT concat(value, '') AS value FROM cef_raw_lines)
                           WHERE CAST(cef_extensions(value)['b'] AS BIGINT) > 1""")
    assert count_calls(optimized_plan(df), "regexp_extract_all") == 2  # one for the filter, one for the column
    assert [r.a for r in df.collect()] == ["1"]


def test_iso_times_are_only_taken_apart_where_they_occur(registered):
    df = lines_df(registered, ["1655789415000", "5"]).select(F.expr("cef_timestamp(value)").alias("t"))
    below = optimized_plan(df).split("\n", 1)[1]  # the columns that are computed for every row
    assert "regexp_replace" not in below
    assert [r.t.year for r in df.collect()] == [2022, 1970]
