"""The monthly, incremental jobs fed by a stream of files."""
