"""Collects every registered query module."""

from __future__ import annotations


def _load():
    from . import catalog, catalog_base, catalog_checks, catalog_views  # noqa: F401

    return catalog


def all_queries():
    return _load().QUERIES


def all_oracles():
    return _load().ORACLES
