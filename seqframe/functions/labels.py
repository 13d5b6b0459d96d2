"""Label code -> label name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The label codes of the news data and their names.
NEWS_LABELS: dict[int, str] = {1: "World", 2: "Sports", 3: "Business", 4: "Sci/Tech"}


def label_name(code: Column | str, mapping: Mapping[int, str] = NEWS_LABELS) -> Column:
    """Name for a code; a code outside the map (or null) gives null."""
    c = F.col(code) if isinstance(code, str) else code
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(int(k)), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), c.try_cast("int"))


def with_label_names(
    df: DataFrame,
    code_col: str = "indexed_label",
    out_col: str = "label",
    mapping: Mapping[int, str] = NEWS_LABELS,
) -> DataFrame:
    """Add the label name and drop the code column."""
    return df.withColumn(out_col, label_name(code_col, mapping)).drop(code_col)
