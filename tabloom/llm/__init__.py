"""Operators for preparing a training corpus of documents."""
