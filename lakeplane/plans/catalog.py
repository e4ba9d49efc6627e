"""All queries of the core, with the SQL they are checked against."""

from __future__ import annotations

from lakeplane.plans import data_problem_sql, data_problems, lakehouse

QUERIES = {**lakehouse.QUERIES, **data_problems.QUERIES}
SQL: dict[str, str] = {**lakehouse.SQL, **data_problem_sql.SQL}
