"""Reading source files and reading or replacing catalog tables."""
