"""The jobs: compositions of sources, operators and sinks."""
