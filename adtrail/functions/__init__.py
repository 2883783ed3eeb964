"""Column expressions; every function returns a Column, none is a Python UDF."""
