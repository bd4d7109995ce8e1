"""Contract-driven data quality and dead-letter processing on PySpark."""

from winnower.contract import COMPAT, STRICT, Contract, Field, Policy, Rule

__all__ = ["COMPAT", "STRICT", "Contract", "Field", "Policy", "Rule"]
