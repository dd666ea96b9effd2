"""Operators of a training-data pipeline over the tables documents, benchmark, pages, embeddings and conversations."""
