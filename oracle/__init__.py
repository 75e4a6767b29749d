"""Independent DuckDB formulations of the registered queries."""

from oracle.kpi_sales import SQL as _SALES
from oracle.kpi_other import SQL as _OTHER_KPIS
from oracle.sql_star import SQL as _STAR
from oracle.sql_quality import SQL as _DQ
from oracle.sql_staging import SQL as _STG
from oracle.sql_ingest import SQL as _INGEST
from oracle.sql_blocks import SQL as _BLOCKS

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(_STAR)
ORACLE_SQL.update(_SALES)
ORACLE_SQL.update(_OTHER_KPIS)
ORACLE_SQL.update(_DQ)
ORACLE_SQL.update(_STG)
ORACLE_SQL.update(_INGEST)
ORACLE_SQL.update(_BLOCKS)
