"""Reusable column and frame helpers."""
