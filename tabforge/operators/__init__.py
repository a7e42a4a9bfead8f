"""Relational and ML operators (DataFrame -> DataFrame)."""
