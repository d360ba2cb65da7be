"""Inputs derived from the given tables, registered queries, SQL oracles."""
