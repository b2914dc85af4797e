"""Writers for every layer (SNK-1..4)."""

from marketlake.sinks.writers import (  # noqa: F401
    publish_table,
    write_bronze,
    write_gold,
    write_silver,
)
