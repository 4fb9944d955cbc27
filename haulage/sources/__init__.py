"""Sources: declared-schema readers, profiles, and the test-table adapter."""
