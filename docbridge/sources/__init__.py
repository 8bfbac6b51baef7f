"""Where documents live: transports, the local store, scans and the query language."""
