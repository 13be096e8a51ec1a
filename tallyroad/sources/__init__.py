"""Sources and sinks: message feeds, text archives, JDBC."""
