"""Where records come from: tables, files, topics, generated sequences."""
