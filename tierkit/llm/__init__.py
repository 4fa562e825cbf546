"""Operators of a training-data pipeline, each in a module of its own.

``queries.py`` registers one query per operator; nothing outside this
subpackage imports it.
"""
