"""Operators: population, income profile, contacts, relations, risk, profiles,
address and audit -- each a function from DataFrames to a DataFrame."""
