"""lethe: key-driven erasure and masking of tables on Spark."""

from lethe.config import (
    DeletionConfig,
    DeletionRule,
    Group,
    Hop,
    KeyPath,
    MaskingConfig,
    MaskingRule,
    Relation,
)

__all__ = [
    "DeletionConfig",
    "DeletionRule",
    "Group",
    "Hop",
    "KeyPath",
    "MaskingConfig",
    "MaskingRule",
    "Relation",
]
