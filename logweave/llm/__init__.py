"""Operators for large training-data corpora (quality, dedup, secrets, mixing, packing, ...).

One module per operator with a general interface; ``queries`` registers the thin
``opN_<name>`` queries. Nothing outside this subpackage imports it.
"""
