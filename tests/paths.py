"""Folders of the given tables; imported by name, as a conftest must not be."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
