"""Readers (S1, S2, S4) and the adapter views over the provided tables."""
