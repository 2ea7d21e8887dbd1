"""Column-expression functions (no DataFrame in, Column out)."""
