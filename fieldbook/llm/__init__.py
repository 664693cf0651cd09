"""Operators for preparing training text: each works on whole tables of any size."""
