"""Preparing, checking and scoring model-training records with Spark DataFrames.

Every public function takes and returns a ``DataFrame`` (or a ``Column``), so
Catalyst sees one declarative plan.  Model calls are the exception: they run as
Arrow-batched Python and are always written to a table before they are reused.
"""
