"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from tabflow.functions.hashing import hash_bucket, hash_int, hash_unit
from tabflow.functions.ids import format_id, id_suffix
from tabflow.functions.dates import register_sql_functions, years_since

__all__ = [
    "format_id", "hash_bucket", "hash_int", "hash_unit", "id_suffix", "register_sql_functions", "years_since",
]
