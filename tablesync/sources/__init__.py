"""Where tables are read from: scans, catalogs and connections."""
