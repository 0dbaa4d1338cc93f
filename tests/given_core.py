"""Folders of the given tables (a plain module: two folders hold a ``conftest``, so nothing imports that name)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
