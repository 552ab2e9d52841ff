"""Composed plans.

* ``star``: the five star-table builders and ``run_pipeline``.
* ``reports``: plays per hour, top users and plays by location, as DataFrames.
* ``sql_reports``: the same reports as Spark SQL text over registered views.
* ``catalog``: database and table administration.
* ``analogues``: the driver's tables seen as play logs.
* ``registry`` and ``oracle``: the registered queries and their DuckDB SQL.
"""
