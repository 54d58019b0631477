"""File discovery and table scans."""
