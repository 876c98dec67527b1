"""Readers, landed-payload normalisers, sinks and catalog helpers."""
