from pelagia.functions.expressions import (  # noqa: F401
    cluster_name, concat_key, group_label, haversine_km, is_noise, percent_text, stable_order, to_double,
)
