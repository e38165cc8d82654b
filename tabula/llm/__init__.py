"""Training-data operators for very large document corpora.

Nothing outside this package imports it (``__spark_entry__.py`` adds its
queries when the package is present).
"""
