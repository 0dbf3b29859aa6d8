"""The functions SQL users call by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(
         id BIGINT, name STRING, separator STRING) RETURNS STRING
       RETURN concat_ws(separator, CAST(id AS STRING), name)""",
    r"""CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(
         document STRING, field STRING) RETURNS STRING
       RETURN get_json_object(document, '$[\'' || field || '\']')""",
    """CREATE OR REPLACE TEMPORARY FUNCTION concat_distinct(
         items ARRAY<STRING>) RETURNS STRING
       RETURN nullif(array_join(array_sort(array_distinct(items)), ','), '')""",
)


def register_sql_functions(spark: SparkSession) -> None:
    """Make them known to ``spark.sql``.

    They are SQL functions, which Catalyst inlines, so they run as built-ins do. Joining a group's
    distinct values is a built-in aggregate:
    ``listagg(DISTINCT x, ',') WITHIN GROUP (ORDER BY x)``; ``concat_distinct`` does it for an array.
    """
    for statement in _FUNCTIONS:
        spark.sql(statement)
