"""Column builders: array (``arrays``) and calendar (``dates``) expressions, all built-in Spark SQL."""
