"""Sources: incremental JSON-lines streams with persisted schema and rescue, file / table / SQL / metric-view
sources, master data and pipeline parameters."""
