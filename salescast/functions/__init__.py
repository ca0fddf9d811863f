"""Column-expression helpers. Everything here returns a pyspark Column and stays
inside whole-stage codegen (no Python on the row path)."""
