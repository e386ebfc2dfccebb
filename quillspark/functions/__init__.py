from quillspark.functions.keys import key, key_sql, unit, unit_sql
from quillspark.functions import text

__all__ = ["key", "key_sql", "unit", "unit_sql", "text"]
