"""All queries of this package, with their SQL."""

import corpus_pipeline
from callscope.llm import (  # noqa: F401  each registers its query
    decontamination,
    embedding_links,
    filter_audit,
    importance,
    language,
    mixing,
    near_duplicates,
    personal_data,
    repeats,
    sharding,
    syncmers,
    url_rules,
    warc,
)
from callscope.llm.registry import QUERIES as _OPERATORS
from callscope.llm.registry import SQL as _OPERATOR_SQL

QUERIES = _OPERATORS | {"pipeline": corpus_pipeline.run}
SQL = _OPERATOR_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
