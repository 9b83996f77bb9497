"""Operators of a training-data pipeline over documents, vectors and chats.

One module per operator; ``queries.py`` registers one query for each of them.
Nothing else in the library imports this package.
"""
