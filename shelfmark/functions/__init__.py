"""Column expressions (and the two Python kernels) the operators are built from."""
