"""Column expressions: all built-in functions, all inside generated code."""
