"""Training-data operators: one module per operator, see README.md.

Nothing outside this package (but ``corpus_pipeline.py`` and the entry point)
imports it. Every operator takes DataFrames and returns DataFrames.
"""
