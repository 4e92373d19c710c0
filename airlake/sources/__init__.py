"""Landing files, the raw table, the weather source and the test-data adapters."""
