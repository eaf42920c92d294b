"""Writers: partitioned overwrite, archive append, partition swap, catalog inserts, JSON."""

from tidemark.sinks.files import insert_partitions, swap_partitions, write_json, write_partitioned

__all__ = ["insert_partitions", "swap_partitions", "write_json", "write_partitioned"]
