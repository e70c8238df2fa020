from adpulse.streaming.sources import message_stream, to_topic, topic_sink_options, write_topic
from adpulse.streaming.jobs import (coarse_stream, fine_stream, impression_stream, read_metrics,
                                    read_totals, rows_dropped_by_watermark, share_wide_stream,
                                    shuffle_partitions, start_impression_job)

__all__ = [n for n in dir() if not n.startswith("_")]
