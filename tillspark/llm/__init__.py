"""Operators for building training corpora. Nothing else in tillspark imports this subpackage."""
