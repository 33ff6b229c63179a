"""Column functions: Column in, Column out, all inside Spark's own expressions."""
