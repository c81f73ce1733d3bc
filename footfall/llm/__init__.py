"""Operators for preparing training data; see the modules, one per operator."""
