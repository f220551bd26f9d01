"""Training-data operators: quality rules, deduplication, decontamination,
extraction, license scans, tokenisation, binary output and sharding.

Nothing outside this package and ``corpus_pipeline.py`` imports it. Every
operator takes DataFrames and returns DataFrames; ``queries.py`` registers
one query per operator over the ``documents`` or ``pages`` table.
"""
