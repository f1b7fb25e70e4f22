"""The operators' registered queries, and the pipeline's."""

import corpus_pipeline
from tessera.llm import queries

QUERIES = {**queries.QUERIES, "pipeline": corpus_pipeline.run}
ORACLES = dict(queries.ORACLES)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
