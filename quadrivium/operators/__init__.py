"""Distributed operators shared by the plans."""
