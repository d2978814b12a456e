"""ledgerlens: monthly lending-funnel analytics on Spark DataFrames.

Every operator is a plain function from DataFrames (plus scalar
parameters) to a lazy DataFrame; nothing is collected inside an
operator except small, size-checked planning guards.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
