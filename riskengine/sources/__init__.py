"""Sources and sinks: files, versioned features, JSON messages, test views."""
