"""Training-data operators: token files, packing, de-duplication, classifiers, extraction.

Nothing outside this subpackage imports it; ``__spark_entry__`` registers
``llm.queries`` only when it can be imported.
"""
