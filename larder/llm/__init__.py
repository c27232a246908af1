"""Operators for preparing large training corpora.

Nothing else in the library imports this subpackage; it may import general helpers only."""
