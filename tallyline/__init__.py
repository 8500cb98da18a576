"""Loan servicing analytics on Spark DataFrames.

sources    input contracts, readers, writers, and analogue inputs over the driver tables
functions  column expressions and the business-day calendar
operators  alignment, running totals, loan terms, data-quality checks, lookups
plans      the user-level ledgers, the query registry and its oracle SQL
"""
