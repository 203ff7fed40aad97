"""Distributed writers for the fact table and the results."""

from tillstar.shared import remove_path, scratch, shared_path
from tillstar.sinks.bucketed import read_bucketed_fact, write_bucketed_fact
from tillstar.sinks.commit import discard, finish, staged
from tillstar.sinks.writers import put_fact, put_result, write_fact, write_result

__all__ = [
    "discard",
    "finish",
    "put_fact",
    "put_result",
    "read_bucketed_fact",
    "remove_path",
    "scratch",
    "shared_path",
    "staged",
    "write_bucketed_fact",
    "write_fact",
    "write_result",
]
