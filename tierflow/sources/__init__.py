"""Table scans, landed payloads and scratch space."""
