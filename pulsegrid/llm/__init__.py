"""Training-data operators: one module per operator, ``queries`` registers them.

Every operator takes and returns DataFrames, reads whole tables and whole texts, and states
what it does with nulls, empty texts, ties and repeated rows in its docstring. Nothing
outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
