"""The three queries, each through the DataFrame, SQL and RDD interface."""

from tidewatt.plans import df, rdd, sql

FACES = {"df": df, "sql": sql, "rdd": rdd}
QUERIES = ("q1", "q2", "q3")
