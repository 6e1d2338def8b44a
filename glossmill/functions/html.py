"""HTML as plain text, in Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from glossmill.sources.readers import html_text


@F.pandas_udf(StringType())
def to_text(html: pd.Series) -> pd.Series:
    """The text of a piece of HTML; null for null."""
    return html.map(html_text, na_action="ignore")
