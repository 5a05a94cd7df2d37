"""riskpipe: insurance risk analytics on the PySpark DataFrame / SQL / Streaming APIs.

Layout
------
sources/    raw schemas, by-name CSV ingest (strict / lenient), file inventory,
            parquet test adapter
functions/  scoring rules as plain ``Column`` expressions (no Python UDFs) and
            their SQL-function form
operators/  level-1 integration (skew-aware left join), level-2 risk matrix,
            quality metrics, governance (mask / row policy), column classification
plans/      report queries, the SQL surface (governed temp views), the registry
            of named queries and their DuckDB oracle SQL
streaming/  continuous ingest, keyed refresh of the two derived levels, the
            incremental quality monitor, raw compaction
"""

from riskpipe.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
