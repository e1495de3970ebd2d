"""Inputs for the checks: views over the test tables, models that answer by hash."""
