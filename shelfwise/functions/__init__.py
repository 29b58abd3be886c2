from shelfwise.functions.columns import (  # noqa: F401
    array_or_empty,
    effective_price,
    full_category,
    last_path_node,
    micros_to_units,
    resource_id,
)
