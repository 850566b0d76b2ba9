"""Operators for building training corpora for language models.

One module per operator; ``queries`` registers them for the driver. Nothing else in the
library imports this subpackage.
"""
