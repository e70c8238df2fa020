from adpulse.plans.catalog import FLAGSHIP, QUERIES as BATCH_QUERIES
from adpulse.plans.streams import STREAM_QUERIES
from adpulse.plans.oracle import ORACLE_SQL

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}

__all__ = ["QUERIES", "BATCH_QUERIES", "STREAM_QUERIES", "FLAGSHIP", "ORACLE_SQL"]
