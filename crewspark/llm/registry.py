"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import functools
import importlib

from .common import ship_package

MODULES = ["token_orc", "quality", "quotes", "minhash", "decontaminate", "toxicity", "bpe", "reshard", "vectors", "language", "fingerprints", "codes", "manifest"]


def _modules():
    return [importlib.import_module(f"{__package__}.{name}") for name in MODULES]


def _shipped(fn):
    """The query, with this package's code at hand on every worker."""

    @functools.wraps(fn)
    def run(spark, sf_dir):
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def queries() -> dict:
    import corpus_pipeline

    found = {name: _shipped(fn) for module in _modules() for name, fn in module.QUERIES.items()}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    import corpus_pipeline

    found = {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
