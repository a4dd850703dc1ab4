"""End-to-end jobs, the registered query catalog and its SQL oracle."""
