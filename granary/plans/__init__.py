"""Compositions of operators: the layered batch job and the star-schema query catalog."""
