"""Operators for preparing large text corpora, their registered queries and checks."""
