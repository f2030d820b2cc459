"""Column expressions. Everything stays in built-in functions, so it runs inside generated code."""
