from shelfwise.sources.readers import (  # noqa: F401
    InputPaths,
    RetailInputs,
    load_geo_targets,
    load_language_codes,
    read_inputs,
    read_or_empty,
    read_table,
    restrict_days,
)
