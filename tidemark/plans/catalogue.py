"""All queries of the core."""

from tidemark.plans import fields, problems, quality, relations

_PARTS = (problems, fields, relations, quality)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}
