"""End-to-end programs: ingest, analyse, maintain, monitor, train."""
