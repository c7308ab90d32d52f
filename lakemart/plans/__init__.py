"""Logical plans: the layers as lazy DataFrames, the named-query registry and
its SQL oracle."""
