"""Operators: DataFrame -> DataFrame functions for every layer."""
