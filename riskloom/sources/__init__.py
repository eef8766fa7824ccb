"""File listing, matrix / CSV / JSON / registry scans, and sinks."""
