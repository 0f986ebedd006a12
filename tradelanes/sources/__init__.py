"""Sources and sinks (S1-S13): landed CSV scans with contracts, landing,
content hashing and the manifest, refresh, counted writes, gold layout."""
