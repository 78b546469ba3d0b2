"""Surrogate keys.

``uuid`` keys are random: a plan that is evaluated twice produces different
ids, so the keyed table is written once and read back before anything joins
on the key (``plans.pipeline.key_linked_trips``).  ``hash`` keys are
deterministic (SHA-256 of the chosen key columns) and need no storing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_surrogate_key(df: DataFrame, name: str = "unique_id", method: str = "uuid",
                       key_cols: Sequence[str] = ()) -> DataFrame:
    """Prepend ``name`` to all columns of ``df``."""
    if method == "uuid":
        key = F.expr("uuid()")
    elif method == "hash":
        if not key_cols:
            raise ValueError("hash keys need key_cols")
        # every value carries its length and NULL has a form of its own, so different keys differ
        parts = [F.col(c).cast("string") for c in key_cols]
        key = F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("N")) for p in parts]), 256)
    else:
        raise ValueError(f"unknown key method {method!r}")
    return df.select(key.alias(name), "*")
