"""Unicode forms, for which Spark has no built-in: an Arrow UDF that only sees texts beyond ASCII."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """Compatibility composition; ASCII texts stay in the JVM as they are."""
    return F.when(c.rlike(r"^[\x00-\x7f]*$"), c).otherwise(_nfkc(F.when(~c.rlike(r"^[\x00-\x7f]*$"), c)))
