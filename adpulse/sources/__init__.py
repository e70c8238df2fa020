from adpulse.sources.tables import read_table
from adpulse.sources.impressions import impression_columns, impressions_from_events, known_geo
from adpulse.sources.codec import (accepted, decode_permissive, decode_strict, encode_messages,
                                   rejects)
from adpulse.sources.sinks import (batch_writer, decode_dates, encode_dates,
                                   stored_count, write_partials, write_results)

__all__ = [n for n in dir() if not n.startswith("_")]
