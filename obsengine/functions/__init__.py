"""Column-level functions (Column in, Column out).  All are built-in Spark
expressions, so they stay inside whole-stage code generation."""
