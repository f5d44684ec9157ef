"""Scalar column expressions (all built-in Spark functions, codegen-friendly)."""
