"""Operators for preparing training corpora, each built by one named method."""
