"""Composed plans: the query catalogue, its SQL oracle and the medallion run."""
