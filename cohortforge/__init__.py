"""cohortforge: entity feature sets and model datasets on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Catalyst expressions, so predicate pushdown,
column pruning and whole-stage codegen apply unchanged.
"""

__version__ = "0.1.0"
