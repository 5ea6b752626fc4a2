"""Splitting a result row into typed columns and the free-form metadata object."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill import schemas


def split_payload(rows: DataFrame, extra_metadata: list[str] | None = None) -> DataFrame:
    """Typed columns as they are (null clears) plus ``metadata_patch`` of the present others.

    ``to_json`` leaves null fields out, so a patch never clears an older value.
    """
    keys = [k for k in schemas.METADATA_COLUMNS + (extra_metadata or []) if k in rows.columns]
    patch = F.nullif(F.to_json(F.struct(*keys)), F.lit("{}"))
    return rows.select("company_number", *schemas.TYPED_COLUMNS, patch.alias("metadata_patch"))
