"""End-to-end jobs: each wires sources, operators, gates and sinks for one run."""
