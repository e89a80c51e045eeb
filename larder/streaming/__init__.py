from larder.streaming.compaction import compact, read_live, tidy
from larder.streaming.published import (
    append_batch_to,
    is_published,
    process_new,
    read_published,
    stream_files,
    wait_until_published,
)
from larder.streaming.wordcount import compact_counts, count_new_lines, merged_counts

__all__ = [
    "append_batch_to",
    "compact",
    "compact_counts",
    "count_new_lines",
    "is_published",
    "merged_counts",
    "process_new",
    "read_live",
    "read_published",
    "stream_files",
    "tidy",
    "wait_until_published",
]
