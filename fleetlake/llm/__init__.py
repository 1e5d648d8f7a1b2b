"""Operators for training-data pipelines. Nothing outside this folder, ``corpus_pipeline.py``
and the guarded import of ``__spark_entry__.py`` depends on it."""
