"""Helper that test modules import by name (conftest modules cannot be: two folders have one)."""


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")
