"""Operators for preparing language-model training data.

Ten operators, one module each, with the queries that apply them in ``queries``. Nothing else in the library imports
this subpackage. Text operators run as Arrow functions inside Spark tasks: Spark reads, deals and joins the rows, a task
holds one bounded slice of texts at a time, and no operator keeps state in files of its own.
"""
