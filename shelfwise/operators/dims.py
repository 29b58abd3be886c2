"""Reference dimensions reduced to the pairs the joins need (AG1, AG2)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def geo_countries(geo_targets: DataFrame) -> DataFrame:
    """Distinct ``(parent_id, country_code)``: ad countries match by parent id."""
    return geo_targets.select("parent_id", "country_code").distinct()


def language_codes(languages: DataFrame) -> DataFrame:
    """Distinct ``(criterion_id, language_code)``; the shipped list repeats
    some ids under two names, which would double count without this."""
    return languages.select("criterion_id", "language_code").distinct()
