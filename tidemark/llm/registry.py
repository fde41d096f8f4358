"""What the entry point registers: the operators' queries and the pipeline."""

import corpus_pipeline
from tidemark.llm.queries import ORACLE_SQL, QUERIES

LLM_QUERIES = QUERIES | {"pipeline": corpus_pipeline.run}
LLM_SQL = ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
