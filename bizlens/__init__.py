"""bizlens: business-analytics operators on Spark DataFrames.

Layout:
  functions/  column expressions (text cleaning, calendar rules, ordered lists)
  operators/  DataFrame -> DataFrame operators (aggregates, ranking, as-of and
              interval joins, state transitions, ledgers, impact, funnels, coverage)
  sources/    readers for the parquet inputs and the domain tables derived from them
  plans/      the named queries, one per business question, with their SQL oracles
  streaming/  the same operators applied to Structured Streaming inputs
"""

__all__ = ["session"]
