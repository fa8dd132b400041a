"""Column-level helpers: label maps, bucket filters, hash splits, tokens.

Everything here builds built-in Spark expressions (JVM side, inside
whole-stage codegen); no Python runs per row.
"""
