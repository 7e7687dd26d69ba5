"""Where results go: topics, files, tables, the console."""
