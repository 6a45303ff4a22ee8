from .aggregate import group_count, rounded_mean, share_of_counts, share_of_total
from .dedup import latest_per_key
from .features import transaction_features
from .keys import assign_keys, hash_split, in_test, max_key, split_hash
from .lookup import asof_lookup, current_lookup, left_lookup
from .merge import fact_upsert, null_key_rows, scd1_merge, scd2_close, scd2_merge, scd2_new_versions

__all__ = [
    "group_count", "rounded_mean", "share_of_counts", "share_of_total", "latest_per_key", "transaction_features",
    "assign_keys", "hash_split", "in_test", "max_key", "split_hash", "asof_lookup", "current_lookup",
    "left_lookup", "fact_upsert", "null_key_rows", "scd1_merge", "scd2_close", "scd2_merge",
    "scd2_new_versions",
]
