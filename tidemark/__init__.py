"""Tidemark: control-table-driven layered batch ingestion on Spark DataFrames."""

from tidemark.config import LakeConfig
from tidemark.plans.curate import curate
from tidemark.plans.ingest import ingest
from tidemark.plans.publish import publish_ready, read_gold, read_silver
from tidemark.state import ControlTable

__all__ = [
    "LakeConfig",
    "ControlTable",
    "curate",
    "ingest",
    "publish_ready",
    "read_gold",
    "read_silver",
]
