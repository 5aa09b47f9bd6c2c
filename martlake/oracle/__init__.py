"""Independent DuckDB SQL for each registered job (the correctness oracle).

The SQL is written from the semantics, with windows and plain aggregates, not
from the Spark code; it runs against the same Parquet tables registered as views.
"""

from martlake.oracle.absa import SQL as _ABSA
from martlake.oracle.category import SQL as _CATEGORY
from martlake.oracle.feedback import SQL as _FEEDBACK
from martlake.oracle.marts import SQL as _MARTS
from martlake.oracle.product import SQL as _PRODUCT
from martlake.oracle.sources import SQL as _SOURCES

ORACLE: dict[str, str] = {}
for _part in (_PRODUCT, _FEEDBACK, _ABSA, _CATEGORY, _SOURCES, _MARTS):
    ORACLE.update(_part)
