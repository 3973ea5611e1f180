"""Table and sheet sources, snapshot and freeze-store sinks."""
