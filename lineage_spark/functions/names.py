"""Column-name helpers (metadata only, evaluated on the driver over the schema)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """Platform naming: every ``.`` becomes ``_``, then every ``-`` becomes ``.``."""
    return re.sub("-", ".", re.sub(r"\.", "_", name))


def quoted(name: str):
    """Column reference that survives dots and other specials in the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`clean_name` (one projection, no data pass)."""
    return df.select([quoted(c).alias(clean_name(c)) for c in df.columns])
