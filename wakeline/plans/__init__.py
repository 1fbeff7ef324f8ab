"""Compositions: the three feature sets, the ensemble, the query catalog."""
