"""Changelog, sharding, split and metric operators."""
