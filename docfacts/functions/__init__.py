"""Column expressions. Nothing here runs Python on the workers."""
