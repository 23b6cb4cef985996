"""Sources and sinks: CSV postings, skill vocabularies, test-table adapters, KPI sink."""
