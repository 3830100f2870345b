"""Sources and sinks: tables, landed documents, message topics."""
