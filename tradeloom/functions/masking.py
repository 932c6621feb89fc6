"""Column masking for readers outside the privileged group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK_PREFIX = "CUSTOMER_"  # fixed value
MASK_HEX_DIGITS = 10  # fixed value


def mask_customer(column: Column, privileged: bool | Column = False) -> Column:
    """The value itself for privileged readers, else a stable pseudonym; NULL stays NULL."""
    allowed = privileged if isinstance(privileged, Column) else F.lit(privileged)
    pseudonym = F.concat(F.lit(MASK_PREFIX), F.right(F.sha2(column, 256), F.lit(MASK_HEX_DIGITS)))
    return F.when(allowed, column).otherwise(pseudonym)


def masked_view(df: DataFrame, columns: list[str], privileged: bool = False) -> DataFrame:
    """``df`` with the named columns masked; publish this instead of the table."""
    return df.withColumns({name: mask_customer(F.col(name), privileged) for name in columns})


def register_mask_function(
    spark: SparkSession, name: str = "mask_customer", privileged_when: str = "false"
) -> None:
    """Make the mask callable from SQL; ``privileged_when`` is the SQL test for full access."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING "
        f"RETURN CASE WHEN {privileged_when} THEN value ELSE "
        f"concat('{MASK_PREFIX}', right(sha2(value, 256), {MASK_HEX_DIGITS})) END"
    )
