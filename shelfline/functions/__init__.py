"""Column-level helpers; everything here is a built-in expression and stays in codegen."""
