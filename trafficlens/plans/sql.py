"""The DuckDB SQL of every registered traffic query."""

from .oracle import SQL as PLAIN_SQL
from .oracle_models import MODEL_SQL
from .oracle_streams import STREAM_SQL

SQL = {**PLAIN_SQL, **MODEL_SQL, **STREAM_SQL}
