"""Training-data operators: Spark jobs over ``documents``, ``labels`` and ``embeddings``.

Nothing else in the library imports this package; ``queries`` holds the
registered queries.
"""
