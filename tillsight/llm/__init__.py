"""Operators for preparing training text: each module holds one operator and its query."""
