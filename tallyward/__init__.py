"""Tallyward: data-quality checks, normalization and sales reporting on Spark DataFrames."""
