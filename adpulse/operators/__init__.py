from adpulse.operators.aggregate import (averages, coarse_groups, event_time, finalise, fine_partials, merge_partials,
                                         sliding_from_partials, uniques, uniques_exact,
                                         uniques_one_shot, window_aggregate, window_bounds)
from adpulse.operators.metrics import (counter_text, day_bucket, envelope_messages, gauge_text, gauges,
                                       geo_bid_share, geo_bid_share_wide, geo_impressions,
                                       group_count, ingest_counter, ingest_reports, latest_n,
                                       messages_per_window, metric_envelope, pivot_fixed,
                                       point_ceiling, point_ceiling_long, report_increment, route_by_target,
                                       row_ceiling, running_total, storage_ratio, stored_metric, sum_by_key,
                                       unpivot_series, window_metrics)

__all__ = [n for n in dir() if not n.startswith("_")]
