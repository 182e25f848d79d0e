"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tessera.functions.hashing import key_hash, row_hash
from tessera.functions.timeofday import millis_to_hms, hms_to_seconds

__all__ = ["row_hash", "key_hash", "millis_to_hms", "hms_to_seconds"]
