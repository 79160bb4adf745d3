"""The table jobs: sources, operators and sinks composed into one plan each."""
