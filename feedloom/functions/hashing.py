"""Content hashes of a posting. They ignore ids, places and web addresses."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import clean_for_hash, strip


def base64_sha256(col: Column) -> Column:
    return F.base64(F.unhex(F.sha2(col, 256)))


def hash_type(col: Column) -> Column:
    """The employment type as it enters the hash: anything that mentions FULL counts as full time."""
    full = F.contains(F.upper(F.coalesce(col, F.lit(""))), F.lit("FULL"))
    return F.when(full, F.lit("FULL_TIME")).otherwise(F.lit("PART_TIME"))


def canonical_text(title: Column, company: Column, kind: Column, description: Column) -> Column:
    """``title|company|type|cleaned description``; missing parts count as empty."""
    return F.concat_ws(
        "|",
        strip(F.coalesce(title, F.lit(""))),
        strip(F.coalesce(company, F.lit(""))),
        hash_type(kind),
        clean_for_hash(description),
    )


def canonical_hash(
    title: str | Column = "title",
    company: str | Column = "company_name",
    kind: str | Column = "employment_type",
    description: str | Column = "description",
) -> Column:
    """Base64 of the SHA-256 of the canonical text."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (title, company, kind, description)]
    return base64_sha256(canonical_text(*parts))


@F.pandas_udf(T.StringType())
def _compact_json(company: pd.Series, description: pd.Series, kind: pd.Series, title: pd.Series) -> pd.Series:
    names = ("company_name", "description", "employment_type", "title")
    return pd.Series(
        [
            json.dumps({n: None if pd.isna(v) else v for n, v in zip(names, row)}, separators=(",", ":"))
            for row in zip(company, description, kind, title)
        ],
        dtype="object",
    )


def json_hash(
    title: str = "title",
    company: str = "company_name",
    kind: str = "employment_type",
    description: str = "description",
) -> Column:
    """The older hash: over compact JSON with sorted keys, non-ASCII written as ``\\uXXXX``.

    ``to_json`` writes non-ASCII characters as they are, hence the Arrow helper for the text only.
    """
    return base64_sha256(_compact_json(F.col(company), F.col(description), F.col(kind), F.col(title)))
