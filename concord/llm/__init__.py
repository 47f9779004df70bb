"""Operators for large training-data pipelines: operators over document, label and vector tables.

Nothing else in the library imports this package; ``__spark_entry__`` adds its queries when it is present.
"""
