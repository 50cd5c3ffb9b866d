"""Column expressions. Nothing here is a Python UDF: all of it stays inside codegen."""
