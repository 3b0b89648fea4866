"""Column expressions: every one a composition of Spark built-ins, so plans stay in codegen."""
