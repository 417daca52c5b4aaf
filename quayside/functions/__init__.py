"""Column-expression building blocks (JVM-side, no Python per row)."""

from quayside.functions.json import is_object, is_present, is_truthy, is_valid, set_object_keys
from quayside.functions.timestamps import event_time_columns, python_isoformat
from quayside.functions.wire import frame, frame_body, frame_magic, frame_ok, frame_schema_id

__all__ = [
    "event_time_columns", "frame", "frame_body", "frame_magic", "frame_ok", "frame_schema_id",
    "is_object", "is_present", "is_truthy", "is_valid", "python_isoformat", "set_object_keys",
]
