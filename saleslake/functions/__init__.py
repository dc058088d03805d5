"""Column-level building blocks: names, audit stamps, type conformance, quality rules."""

from saleslake.functions.columns import conform, standardize_names, with_audit
from saleslake.functions.quality import RULES, apply_rules, cleanse

__all__ = ["RULES", "apply_rules", "cleanse", "conform", "standardize_names", "with_audit"]
