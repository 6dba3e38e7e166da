"""Compositions of operators: the staged job and the driver's queries."""
