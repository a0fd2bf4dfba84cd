"""Operators of a training-data pipeline over document tables.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
