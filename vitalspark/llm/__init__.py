"""Operators for preparing language-model training data (documents, conversations, embeddings)."""
