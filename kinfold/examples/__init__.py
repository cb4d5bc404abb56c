"""Every operator as a query over the test tables, next to the SQL that checks it."""

from __future__ import annotations

from . import joining, people, serving, shaping, travel


def catalogue() -> dict:
    """{name: (callable(spark, sf_dir), check SQL or None)}"""
    out: dict = {}
    for module in (shaping, joining, serving, people, travel):
        for name, pair in module.QUERIES.items():
            if name in out:
                raise ValueError(f"two queries named {name}")
            out[name] = pair
    return out
