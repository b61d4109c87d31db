"""Operators for large training corpora (documents and embeddings).

Nothing else in the library imports this package; it may use the library's
general helpers (session, checkpoint folder).
"""
