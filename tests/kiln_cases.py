"""Folders of the test tables, shared by the tests (a module of its own:
``conftest`` is a name that more than one folder uses)."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
