"""Column-expression builders.  All are built-in Spark functions (JVM side,
whole-stage codegen); none of them is a Python UDF."""
from tidewatch.functions.parse import (  # noqa: F401
    split_payload, parse_fields, payload_hash, payload_text, reject_reason,
)
from tidewatch.functions.transform import log_shift, cap, label_text  # noqa: F401
from tidewatch.functions.classes import (  # noqa: F401
    argmax_index, max_probability, decode_class, binary_prediction, status_display,
)
from tidewatch.functions.keys import event_time_text, row_key, index_doc_id  # noqa: F401
from tidewatch.functions.formats import clock_text, timestamp_text, one_decimal_rate  # noqa: F401
