"""Sources (logical table readers, adapters over test tables) and sinks."""
