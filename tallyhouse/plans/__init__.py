"""Compositions of operators: the warehouse, and the binding of the driver's tables to it."""
