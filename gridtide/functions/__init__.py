"""Scalar rules: every function maps Columns to a Column and stays inside codegen."""
