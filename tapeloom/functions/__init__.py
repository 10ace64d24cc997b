"""Scalar rules over columns: the market calendar, labels and decision tables."""
