"""Analyses built from the operators, one module per subject."""
