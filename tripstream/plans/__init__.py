"""Shared folders, treatment of skewed keys, filters of keys, and layouts of tables."""

from tripstream.plans.layout import morton, write_bucketed, write_by_place
from tripstream.plans.membership import MAX_WORDS, Membership, members
from tripstream.plans.skew import HOT_ROWS, HotKeys, find_hot_keys
from tripstream.plans.storage import new_folder, remove_derived

__all__ = [
    "HOT_ROWS", "HotKeys", "MAX_WORDS", "Membership", "find_hot_keys", "members", "morton", "new_folder", "remove_derived",
    "write_bucketed", "write_by_place",
]
