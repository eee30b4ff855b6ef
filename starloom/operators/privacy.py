"""Sensitivity labels on columns, kept in the schema, and output with labelled text masked."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LABEL = "sensitivity"


def classify(df: DataFrame, labels: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach ``(label, information type)`` to columns; the values stay as they are."""
    for name, (label, information) in labels.items():
        metadata = dict(df.schema[name].metadata)
        metadata[_LABEL] = {"label": label, "information_type": information}
        df = df.withMetadata(name, metadata)
    return df


def classifications(df: DataFrame) -> dict[str, tuple[str, str]]:
    return {
        f.name: (f.metadata[_LABEL]["label"], f.metadata[_LABEL]["information_type"])
        for f in df.schema.fields
        if _LABEL in f.metadata
    }


def masked(df: DataFrame) -> DataFrame:
    """Labelled text keeps only its shape (letters x/X, digits n); other labelled values
    become null."""
    labelled = classifications(df)

    def column(field: T.StructField):
        if field.name not in labelled:
            return F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.mask(field.name).alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])
