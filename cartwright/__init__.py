"""Incremental retail analytics as plain Spark DataFrame transforms."""

from cartwright.config import RuleBook, v1_rules, v2_rules

__all__ = ["RuleBook", "v1_rules", "v2_rules"]
