"""Operators over DataFrames: cleaning, scoring, blending, rules, joins and metrics."""
