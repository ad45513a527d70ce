"""All queries of this package and their DuckDB SQL, by name."""
from __future__ import annotations

from . import (centroids, chat, jaccard, language, licenses, mixing, packing, paragraphs, phrases, quality, rendering,
               repair, tokens)

MODULES = (licenses, mixing, phrases, language, packing, rendering, tokens, jaccard, quality, paragraphs, centroids,
           chat, repair)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
