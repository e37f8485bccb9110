"""All core queries and their SQL."""

from . import archive, curation, dialects

QUERIES = {**archive.QUERIES, **curation.QUERIES, **dialects.QUERIES}
SQL = {**archive.SQL, **curation.SQL, **dialects.SQL}
