"""Training-data operators: one module per operator, their queries in ``queries``.

Nothing outside this folder (and ``corpus_pipeline.py`` at the repository top)
imports it, so it can be removed as a whole.
"""
