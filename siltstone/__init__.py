"""A PySpark engine for curating text corpora and for retrieval analytics."""
