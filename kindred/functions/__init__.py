"""Column-level functions (all JVM-side built-ins, no Python UDFs)."""
from kindred.functions.text import (  # noqa: F401
    clean_name, clean_name_str, blank_to_other, matches, word_count)
from kindred.functions.calendar import (  # noqa: F401
    parse_date, publish_date_local, day_name, weekpart, day_of_month, month,
    epoch_to_utc, epoch_to_text, text_to_timestamp, to_local, session_start,
    business_hours)
