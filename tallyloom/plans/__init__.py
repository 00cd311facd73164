"""Whole analysis stages composed from the operators."""
