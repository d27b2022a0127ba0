"""Operators for building training corpora (see the README, "Corpus operators").

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it; the package works without it.
"""
