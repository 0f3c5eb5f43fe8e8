"""Layerloom: metadata-driven warehouse layers on Spark DataFrames.

Landing -> bronze -> silver -> versioned dimensions -> sales facts -> publish,
with every step written as a declarative DataFrame transformation.
"""

from layerloom.context import RunContext, TechnicalColumns

__all__ = ["RunContext", "TechnicalColumns"]
