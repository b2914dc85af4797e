"""Readers for every layer (SRC-1..6)."""

from marketlake.sources.bronze import (  # noqa: F401
    PATH_PATTERN,
    read_bronze,
    read_ticks,
    split_corrupt,
    with_path_partitions,
)
from marketlake.sources.silver import read_layer, read_stored  # noqa: F401
