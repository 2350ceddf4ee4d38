from .dedupe import (best_per_child, best_per_child_from_parts, contenders, latest_per_key,
                     top1_per_group)
from .joins import (expand_children, key_option_pairs, normalize_child_table,
                    require_columns, resolve_column, semi_exists_keys, semi_filter_children,
                    serial_join)
from .rollup import (build_order_key, config_counts, config_engine_counts, distinct_options,
                     distinct_years, engine_count_total, with_config_id)

__all__ = [
    "best_per_child", "best_per_child_from_parts", "build_order_key", "config_counts",
    "config_engine_counts", "contenders", "distinct_options", "distinct_years",
    "engine_count_total",
    "expand_children", "key_option_pairs", "latest_per_key", "normalize_child_table",
    "require_columns", "resolve_column", "semi_exists_keys", "semi_filter_children",
    "serial_join", "top1_per_group", "with_config_id",
]
