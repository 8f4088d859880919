"""Training-data operators: one module per operator, plain DataFrame functions.

Nothing outside this package imports it. ``queries`` registers one query per
operator; ``corpus_pipeline`` at the repository top chains five of them.
"""
