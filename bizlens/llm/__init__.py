"""Operators for building training data from text and embeddings.

Each module holds one operator with an interface of its own and the query
``opN_<name>`` that applies it to a whole input table; ``registry`` lists them.
Nothing outside this subpackage (but ``corpus_pipeline.py``) imports it.
"""
