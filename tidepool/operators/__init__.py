"""Batch operators: DataFrame -> DataFrame functions, one per reference step."""
