"""Sources: files, JSON lines, HTML tables and links, workbooks."""
