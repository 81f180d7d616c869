"""SQL-bodied masking functions for SQL users.  Their bodies are built-in
expressions, so the analyzer inlines them: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskweave import config as C


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create ``mask_card_number(STRING)`` and ``mask_ip_address(STRING)`` for the session."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION mask_card_number(card STRING) RETURNS STRING "
              f"RETURN concat('{C.CARD_MASK_PREFIX}', right(card, 4))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION mask_ip_address(ip STRING) RETURNS STRING "
              f"RETURN concat(substring_index(ip, '.', 2), '{C.IP_MASK_SUFFIX}')")
    return ["mask_card_number", "mask_ip_address"]
