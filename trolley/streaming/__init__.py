"""Live jobs: the operators on streams, timers and result sinks."""
