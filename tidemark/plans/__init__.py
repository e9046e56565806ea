"""Declarative specs and the plans built from them."""
