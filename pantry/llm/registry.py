"""All queries of this folder, and the pipeline's."""

from __future__ import annotations

import corpus_pipeline

from .queries import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
