"""All registered queries (importing the catalogue modules registers them)."""

from __future__ import annotations

from ..session import ensure_checkpoint_dir
from . import catalog_clean  # noqa: F401
from . import catalog_features  # noqa: F401
from . import catalog_models  # noqa: F401
from .registry import ORACLE, QUERIES


def _wrap(fn):
    def run(spark, sf_dir):
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries():
    return {name: _wrap(fn) for name, fn in QUERIES.items()}


def oracle_sql():
    return dict(ORACLE)


def flagship(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    return catalog_clean.q_class_balance(spark, sf_dir)
