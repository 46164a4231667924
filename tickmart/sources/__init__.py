"""Sources: landed payload scans, raw/model table scans, asset universe."""
