"""Training-data operators: ten corpus operations over ``documents``, ``benchmark`` and ``embeddings``.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_<name>`` queries on top. Nothing else in the library imports
this package.
"""
