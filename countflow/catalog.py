"""Every registered query of the counter operators, with the SQL that checks it."""

from __future__ import annotations

from countflow.plans import analyses, core, io, more

FLAGSHIP = "w1_baseline"
QUERIES = {**core.QUERIES, **more.QUERIES, **analyses.QUERIES, **io.QUERIES}
ORACLE_SQL = {**core.ORACLE_SQL, **more.ORACLE_SQL, **analyses.ORACLE_SQL, **io.ORACLE_SQL}
